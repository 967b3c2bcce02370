"""Target-table specs: what a flat table looks like, before any data is read."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import types as T

from formflow.functions.naming import column_name

# --- fixed values -----------------------------------------------------------
# Table types in processing order: tables that others read come first.
TABLE_TYPES = (
    "Individual",
    "Person",
    "Household",
    "Group",
    "ProgramEnrolment",
    "ProgramExit",
    "ProgramEncounter",
    "ProgramEncounterCancellation",
    "Encounter",
    "IndividualEncounterCancellation",
    "Address",
    "ManualProgramEnrolmentEligibility",
    "GroupToMember",
    "HouseholdToMember",
    "RepeatableQuestionGroup",
    "Checklist",
    "SyncTelemetry",
    "User",
    "Media",
    "MediaAnalysis",
)
SUBJECT_TYPES = ("Individual", "Person", "Household", "Group")
VISIT_TYPES = (
    "Encounter",
    "IndividualEncounterCancellation",
    "ProgramEncounter",
    "ProgramEncounterCancellation",
)
MEDIA_CONCEPTS = ("Image", "ImageV2", "Video", "Audio", "File")
TEXT_SEARCH_CONCEPTS = ("Text", "Id", "Notes")
CODED_CONCEPTS = ("SingleSelect", "MultiSelect")
# A concept type not named here is stored as text.
CONCEPT_TO_PHYSICAL = {
    "Numeric": "numeric",
    "Date": "date",
    "DateTime": "timestamp",
    "Time": "time",
    "ImageV2": "jsonb",
}
# TIME has no stable Spark type, so HH:mm:ss text; JSON is kept as text in
# published tables; a point is a pair of doubles.
PHYSICAL_TO_SPARK = {
    "serial": T.LongType(),
    "integer": T.LongType(),
    "text": T.StringType(),
    "numeric": T.DecimalType(38, 10),
    "date": T.DateType(),
    "timestamp": T.TimestampNTZType(),
    "timestampWithTimezone": T.TimestampType(),
    "time": T.StringType(),
    "bool": T.BooleanType(),
    "point": T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())]),
    "jsonb": T.StringType(),
}
PARENT_KEY = {
    "IndividualProfile": "individual_id",
    "Encounter": "encounter_id",
    "ProgramEnrolment": "program_enrolment_id",
    "ProgramEncounter": "program_encounter_id",
}
APPROVAL_ENTITY = {
    "Household": "Subject",
    "Individual": "Subject",
    "Person": "Subject",
    "Group": "Subject",
    "Encounter": "Encounter",
    "IndividualEncounterCancellation": "Encounter",
    "ProgramEnrolment": "ProgramEnrolment",
    "ProgramExit": "ProgramEnrolment",
    "ProgramEncounter": "ProgramEncounter",
    "ProgramEncounterCancellation": "ProgramEncounter",
}
_COMMON = (
    ("uuid", "text"),
    ("is_voided", "bool"),
    ("created_by_id", "integer"),
    ("last_modified_by_id", "integer"),
    ("created_date_time", "timestampWithTimezone"),
    ("last_modified_date_time", "timestampWithTimezone"),
    ("organisation_id", "integer"),
)
_REPEAT = (
    ("id", "serial"),
    ("last_modified_date_time", "timestampWithTimezone"),
    ("is_voided", "bool"),
    ("organisation_id", "integer"),
    ("repeatable_question_group_index", "integer"),
    ("individual_id", "integer"),
    ("address_id", "integer"),
)
_ID = (("id", "integer"),)
_SUBJECT = (
    ("address_id", "integer"),
    ("registration_date", "date"),
    ("first_name", "text"),
    ("last_name", "text"),
    ("registration_location", "point"),
    ("legacy_id", "text"),
    ("latest_approval_status", "text"),
)
_VISIT = (
    ("name", "text"),
    ("individual_id", "integer"),
    ("address_id", "integer"),
    ("earliest_visit_date_time", "timestampWithTimezone"),
    ("max_visit_date_time", "timestampWithTimezone"),
    ("encounter_date_time", "timestampWithTimezone"),
    ("encounter_location", "point"),
    ("cancel_date_time", "timestampWithTimezone"),
    ("cancel_location", "point"),
    ("legacy_id", "text"),
    ("latest_approval_status", "text"),
    ("filled_by_id", "integer"),
)
_ENROLMENT = (
    ("individual_id", "integer"),
    ("address_id", "integer"),
    ("enrolment_date_time", "timestampWithTimezone"),
    ("program_exit_date_time", "timestampWithTimezone"),
    ("enrolment_location", "point"),
    ("exit_location", "point"),
    ("legacy_id", "text"),
    ("latest_approval_status", "text"),
)
_MEMBER = (("group_subject_id", "integer"), ("member_subject_id", "integer"), ("role", "text"))
_PROGRAM_VISIT = (("program_enrolment_id", "integer"),)
BASE_COLUMNS = {
    "Individual": _ID + _COMMON + _SUBJECT,
    "Household": _ID + _COMMON + _SUBJECT,
    "Group": _ID + _COMMON + _SUBJECT,
    "Person": _ID + _COMMON + _SUBJECT
    + (("date_of_birth", "date"), ("date_of_birth_verified", "bool"), ("gender", "text")),
    "Encounter": _ID + _COMMON + _VISIT,
    "IndividualEncounterCancellation": _ID + _COMMON + _VISIT,
    "ProgramEncounter": _ID + _COMMON + _VISIT + _PROGRAM_VISIT,
    "ProgramEncounterCancellation": _ID + _COMMON + _VISIT + _PROGRAM_VISIT,
    "ProgramEnrolment": _ID + _COMMON + _ENROLMENT,
    "ProgramExit": _ID + _COMMON + _ENROLMENT,
    "ManualProgramEnrolmentEligibility": _ID + _COMMON
    + (
        ("subject_id", "integer"),
        ("program_id", "integer"),
        ("is_eligible", "bool"),
        ("check_date", "timestampWithTimezone"),
    ),
    "GroupToMember": _ID + _COMMON + _MEMBER,
    "HouseholdToMember": _ID + _COMMON + _MEMBER + (("Head of household ID", "integer"),),
    "User": _ID + _COMMON
    + (
        ("username", "text"),
        ("catchment_id", "integer"),
        ("email", "text"),
        ("phone_number", "text"),
        ("name", "text"),
    ),
    "SyncTelemetry": (("id", "serial"),) + _COMMON
    + (
        ("user_id", "integer"),
        ("sync_status", "text"),
        ("sync_start_time", "timestampWithTimezone"),
        ("sync_end_time", "timestampWithTimezone"),
        ("device_name", "text"),
        ("android_version", "text"),
        ("app_version", "text"),
        ("device_info", "text"),
        ("sync_source", "text"),
        ("latest_approval_status", "text"),
    ),
    "Media": (("id", "serial"),) + _COMMON
    + (
        ("address_id", "integer"),
        ("image_url", "text"),
        ("sync_parameter_key1", "text"),
        ("sync_parameter_value1", "text"),
        ("sync_parameter_key2", "text"),
        ("sync_parameter_value2", "text"),
        ("subject_type_name", "text"),
        ("encounter_type_name", "text"),
        ("program_name", "text"),
        ("concept_name", "text"),
        ("entity_id", "integer"),
        ("subject_first_name", "text"),
        ("subject_last_name", "text"),
        ("subject_middle_name", "text"),
        ("media_metadata", "jsonb"),
        ("question_group_concept_name", "text"),
        ("repeatable_question_group_index", "integer"),
    ),
    "MediaAnalysis": (
        ("uuid", "text"),
        ("image_url", "text"),
        ("is_valid_url", "bool"),
        ("is_present_in_storage", "bool"),
        ("is_thumbnail_generated", "bool"),
        ("is_having_duplicates", "bool"),
    ),
    "Address": (("gps_coordinates", "point"),) + _ID + _COMMON,
    "RepeatableQuestionGroup/IndividualProfile": _REPEAT,
    "RepeatableQuestionGroup/Encounter": _REPEAT + (("encounter_id", "integer"),),
    "RepeatableQuestionGroup/ProgramEnrolment": _REPEAT + (("program_enrolment_id", "integer"),),
    "RepeatableQuestionGroup/ProgramEncounter": _REPEAT
    + (("program_enrolment_id", "integer"), ("program_encounter_id", "integer")),
    # Placeholder table of a user-typed subject without a registration form.
    "UserSubject": (
        ("id", "integer"),
        ("uuid", "text"),
        ("user_id", "integer"),
        ("first_name", "text"),
        ("last_name", "text"),
        ("address_id", "integer"),
        ("created_by_id", "integer"),
        ("last_modified_by_id", "integer"),
        ("created_date_time", "timestamp"),
        ("last_modified_date_time", "timestamp"),
        ("organisation_id", "integer"),
        ("is_voided", "bool"),
    ),
}
# --- end of fixed values ----------------------------------------------------


@dataclass(frozen=True)
class ColumnSpec:
    """One column of a flat table; ``concept_*`` is None for a base column."""

    name: str
    type: str
    concept_id: int | None = None
    concept_type: str | None = None
    concept_uuid: str | None = None
    parent_uuid: str | None = None
    parent_name: str | None = None
    voided: bool = False
    role: str | None = None  # "sync1" / "sync2" for sync-attribute columns

    @property
    def is_answer(self) -> bool:
        return self.concept_id is not None

    @property
    def is_sync_attribute(self) -> bool:
        return self.role in ("sync1", "sync2")


def answer_column(
    name: str,
    concept_id: int,
    concept_type: str,
    concept_uuid: str,
    parent_uuid: str | None = None,
    parent_name: str | None = None,
    voided: bool = False,
    role: str | None = None,
) -> ColumnSpec:
    """A column fed by the answers to one question."""
    return ColumnSpec(
        column_name(name),
        CONCEPT_TO_PHYSICAL.get(concept_type, "text"),
        concept_id,
        concept_type,
        concept_uuid,
        parent_uuid,
        parent_name,
        voided,
        role,
    )


def base_columns(kind: str) -> tuple[ColumnSpec, ...]:
    return tuple(ColumnSpec(name, type_) for name, type_ in BASE_COLUMNS[kind])


@dataclass(frozen=True)
class TableSpec:
    """One flat table; identity is type plus uuids, never the name."""

    name: str
    type: str
    subject_type_uuid: str | None = None
    program_uuid: str | None = None
    encounter_type_uuid: str | None = None
    form_uuid: str | None = None
    group_subject_type_uuid: str | None = None
    member_subject_type_uuid: str | None = None
    repeat_uuid: str | None = None
    columns: tuple[ColumnSpec, ...] = field(default_factory=tuple)

    @property
    def identity(self) -> tuple:
        return (
            self.type,
            self.subject_type_uuid,
            self.program_uuid,
            self.encounter_type_uuid,
            self.group_subject_type_uuid,
            self.member_subject_type_uuid,
            self.repeat_uuid,
        )

    @property
    def answers(self) -> tuple[ColumnSpec, ...]:
        return tuple(c for c in self.columns if c.is_answer)

    @property
    def parent_type(self) -> str | None:
        """Which form a repeat-group table hangs off."""
        if not self.repeat_uuid:
            return None
        if self.encounter_type_uuid:
            return "ProgramEncounter" if self.program_uuid else "Encounter"
        return "ProgramEnrolment" if self.program_uuid else "IndividualProfile"

    @property
    def is_user_subject(self) -> bool:
        return self.type == "User" and self.subject_type_uuid is not None

    def has(self, name: str) -> bool:
        return any(c.name == name for c in self.columns)

    def with_columns(self, *extra: ColumnSpec) -> "TableSpec":
        return replace(self, columns=self.columns + tuple(extra))

    def of_concept_types(self, *types: str) -> tuple[ColumnSpec, ...]:
        return tuple(c for c in self.columns if c.concept_type in types)


def spark_type(physical: str) -> T.DataType:
    return PHYSICAL_TO_SPARK[physical]


def to_struct(spec: TableSpec) -> T.StructType:
    return T.StructType([T.StructField(c.name, spark_type(c.type)) for c in spec.columns])


def ordered(specs: list[TableSpec]) -> list[TableSpec]:
    """Specs in processing order."""
    return sorted(specs, key=lambda s: (TABLE_TYPES.index(s.type), s.name))


def pick_tables(specs: list[TableSpec], types: tuple[str, ...]) -> list[TableSpec]:
    """The table family of a view or report."""
    return [s for s in specs if s.type in types and not s.is_user_subject]
