"""From form metadata to target-table specs.

Form metadata is joined with DataFrame operations; what comes out is one row
per (table, question). Only these rows, at most a few thousand for a tenant,
are brought to the driver, where a plan has to be made for each table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from formflow.functions.naming import column_name, table_name, table_name_column
from formflow.model import SUBJECT_TYPES, ColumnSpec, TableSpec, answer_column, base_columns, ordered

# --- fixed values -----------------------------------------------------------
PLACEHOLDER_CONCEPT = "b4e5a662-97bf-4846-b9b7-9baeab4d89c4"
REGISTRATION_FORM = "IndividualProfile"
LOCATION_FORM = "Location"
# table type: (trim kind, name parts, suffix)
NAMING = {
    "Individual": ("Registration", ("subject",), None),
    "Person": ("Registration", ("subject",), None),
    "Household": ("Registration", ("subject",), None),
    "Group": ("Registration", ("subject",), None),
    "ProgramEnrolment": ("ProgramEnrolment", ("subject", "program"), None),
    "ProgramExit": ("ProgramEnrolment", ("subject", "program"), "EXIT"),
    "ProgramEncounter": ("ProgramEncounter", ("subject", "program", "visit"), None),
    "ProgramEncounterCancellation": (
        "ProgramEncounter", ("subject", "program", "visit"), "CANCEL",
    ),
    "Encounter": ("Encounter", ("subject", "visit"), None),
    "IndividualEncounterCancellation": ("Encounter", ("subject", "visit"), "CANCEL"),
    "ManualProgramEnrolmentEligibility": (
        "ProgramEligibility", ("subject", "program"), "manual_program_eligibility",
    ),
    "GroupToMember": ("Registration", ("group", "member"), None),
    "HouseholdToMember": ("Registration", ("group", "member"), None),
}
REPEAT_NAMING = {
    "IndividualProfile": ("RegistrationRepeatableQuestionGroup", ("subject", "repeat")),
    "Encounter": (
        "EncounterRepeatableQuestionGroup", ("subject", "visit", "repeat"),
    ),
    "ProgramEnrolment": (
        "ProgramEnrolmentRepeatableQuestionGroup", ("subject", "program", "repeat"),
    ),
    "ProgramEncounter": (
        "ProgramEncounterRepeatableQuestionGroup",
        ("subject", "program", "visit", "repeat"),
    ),
}
FIXED_TABLES = (("media", "Media"), ("media_analysis", "MediaAnalysis"), ("sync_telemetry", "SyncTelemetry"), ("users", "User"))
# --- end of fixed values ----------------------------------------------------

Meta = Mapping[str, DataFrame]


def _answer(data_type: Column, choice: Column) -> Column:
    """What kind of answer a question takes: of a coded one, whether one or several choices."""
    return F.when(data_type == "Coded", choice).otherwise(data_type)


def _named(meta: Meta, kind: str) -> DataFrame:
    """Programs or visit kinds: their operational name, and whether they have one."""
    names = meta[f"operational_{kind}"].select(F.col(f"{kind}_id").alias("key"), F.struct("name").alias("shown"))
    return meta[kind].select(F.col("id").alias("key"), "uuid").join(names, "key", "left")


def _subjects(meta: Meta) -> DataFrame:
    """Subject types that have an operational name, as a struct by their key."""
    shown = meta["operational_subject_type"].select(F.col("subject_type_id").alias("subject_key"), F.col("name").alias("label"))
    types = meta["subject_type"].withColumnRenamed("id", "subject_key").join(shown, "subject_key")
    return types.select("subject_key", F.struct("uuid", "type", "allow_middle_name", "label").alias("subject"))


def _many(side: DataFrame) -> DataFrame:
    """A side of a join with a row for each form or question: dealt by key, never gathered on the driver for a broadcast.

    Columns of keys pack so well that a table of millions of rows looks small from the size of its files.
    """
    return side.hint("merge")


def _mapped(meta: Meta) -> DataFrame:
    """Form mappings that are not voided, each with its form and the keys of what the form is for."""
    form = meta["form"].select(F.col("id").alias("form_key"), F.struct("uuid", "form_type").alias("form"))
    live = meta["form_mapping"].where(~F.col("is_voided"))
    keys = {"mapping": "uuid", "form_key": "form_id", "subject_key": "subject_type_id", "program_key": "entity_id", "encounter_type_key": "observations_type_entity_id"}
    return live.select(*(F.col(c).alias(k) for k, c in keys.items())).join(_many(form), "form_key")


def _registrations(meta: Meta) -> DataFrame:
    """Which forms register which subject types."""
    return _mapped(meta).where(F.col("form.form_type") == REGISTRATION_FORM).select("subject_key", "form_key").distinct()


def live_mappings(meta: Meta) -> DataFrame:
    """Form mappings in use, each with its form, subject type, program and visit kind as structs.

    A mapping to a program or visit kind without an operational name is not in use.
    """
    rows = _mapped(meta).join(_subjects(meta), "subject_key")
    for name in ("program", "encounter_type"):
        side = _named(meta, name).select(F.col("key").alias(f"{name}_key"), F.struct("uuid", "shown").alias(name))
        rows = rows.join(side, f"{name}_key", "left").where(F.col(name).isNull() | F.col(f"{name}.shown").isNotNull())
    return rows


def live_questions(meta: Meta) -> DataFrame:
    """Live form elements by form: concept, kind of choice, and the group they are in, if that is live.

    Whether a group is repeatable is a mark on its own element, which the group brings along.
    """
    mark = F.from_json("key_values", "array<struct<key:string,value:string>>")
    repeats = F.coalesce(F.exists(mark, lambda m: (m["key"] == "repeatable") & (m["value"] == "true")), F.lit(False))
    live = meta["form_element"].where(~F.col("is_voided"))
    within = live.select(F.col("id").alias("group_id"), F.struct(F.col("concept_id").alias("concept_key"), "type", repeats.alias("repeats")).alias("within"))
    skipped = meta["non_applicable_form_element"].select(F.col("form_element_id").alias("id")).distinct()
    sections = meta["form_element_group"].select(
        F.col("id").alias("form_element_group_id"), F.col("form_id").alias("form_key"), F.coalesce("is_voided", F.lit(False)).alias("section_voided")
    )
    return (
        live.select("id", "form_element_group_id", "group_id", F.col("concept_id").alias("concept_key"), "type")
        .join(_many(sections), "form_element_group_id")
        .join(within, "group_id", "left")
        .join(skipped.withColumn("skipped", F.lit(True)), "id", "left")
        .select("form_key", "section_voided", "concept_key", "type", "within", F.coalesce("skipped", F.lit(False)).alias("skipped"))
    )


def _with_concept(rows: DataFrame, concepts: DataFrame, key: str, name: str, choice: str, how: str = "left") -> DataFrame:
    """``rows`` with the concept of a key as a struct (null if it is not among ``concepts``); ``choice``: the column with the kind of choice."""
    side = concepts.select(F.col("id").alias(f"_{name}"), F.struct("id", "uuid", "name", "is_voided", "data_type").alias("_found"))
    meets = F.col(key) == F.col(f"_{name}")
    if how == "left":  # rows without a key meet nothing; they are dealt by their form and question, not all to one task
        dealt = F.coalesce(F.col(key), F.xxhash64("form_key", "concept_key"))
        meets = (dealt == F.col(f"_{name}")) & F.col(key).isNotNull()
    found = rows.join(_many(side), meets, how)
    answer = _answer(F.col("_found.data_type"), F.col(choice)).alias("answer")
    whole = F.when(F.col("_found").isNotNull(), F.struct("_found.id", "_found.uuid", "_found.name", F.col("_found.is_voided").alias("voided"), answer))
    return found.withColumn(name, whole).drop(f"_{name}", "_found")


def _table_rows(rows: DataFrame, **columns: Column) -> DataFrame:
    """Rows of a mapping and a question, in the shape that ``grouped_specs`` gathers by table."""
    shape = {
        "mapping": F.col("mapping"),
        "form": F.col("form.uuid"),
        "kind": F.col("form.form_type"),
        "parent_kind": F.lit(None).cast("string"),
        "subject": F.col("subject"),
        "program": F.struct("program.uuid", "program.shown.name"),
        "visit": F.struct("encounter_type.uuid", "encounter_type.shown.name"),
        "repeat": F.lit(None).cast("struct<uuid:string,name:string>"),
        "question": F.col("question"),
        "holder": F.col("holder"),
    } | columns
    return rows.select(*(column.alias(name) for name, column in shape.items()))


def form_specs(meta: Meta) -> DataFrame:
    """One row per (form mapping, question) of every form table.

    A form without questions keeps one row without a question. Children of
    repeatable groups are left out; they have tables of their own.
    """
    concepts = meta["concept"]
    answered = concepts.where((F.col("data_type") != "QuestionGroup") & (F.col("uuid") != PLACEHOLDER_CONCEPT))
    questions = _with_concept(live_questions(meta), answered, "concept_key", "question", "type")
    questions = _with_concept(questions, concepts, "within.concept_key", "holder", "within.type")
    rows = live_mappings(meta).join(questions, "form_key", "left")
    left_out = F.coalesce("skipped", F.lit(False)) | F.coalesce("within.repeats", F.lit(False))
    return _table_rows(rows.where(~left_out))


def repeat_specs(meta: Meta) -> DataFrame:
    """One row per (form mapping, repeatable group, question in it)."""
    inside = live_questions(meta).where(~F.col("skipped") & F.col("within.repeats"))
    inside = _with_concept(inside, meta["concept"], "concept_key", "question", "type")
    inside = _with_concept(inside, meta["concept"].where("data_type = 'QuestionGroup'"), "within.concept_key", "holder", "within.type")
    return _table_rows(
        live_mappings(meta).join(inside, "form_key"),
        kind=F.lit("RepeatableQuestionGroup"),
        parent_kind=F.col("form.form_type"),
        repeat=F.when(F.col("holder").isNotNull(), F.struct("holder.uuid", "holder.name")),
        # the group is the table here, so its uuid is no part of the question's address
        holder=F.col("holder").withField("uuid", F.lit(None).cast("string")),
    )


def _first_named(rows: DataFrame, *keys: str) -> DataFrame:
    """One question (its struct) per key and name, always the one with the lowest id."""
    least = F.min(F.struct("question.id", "question.uuid", "question.answer", "question.voided"))
    found = rows.groupBy(*keys, F.col("question.name").alias("name")).agg(least.alias("q"))
    return found.select(*keys, "q.id", "q.uuid", "name", "q.voided", "q.answer")


def decision_cols(meta: Meta) -> DataFrame:
    """Questions decided by rules, per form; a name is taken once."""
    forms = meta["form"].select(F.col("id").alias("form_id"), F.col("uuid").alias("form"))
    decided = meta["decision_concept"].join(forms, "form_id").select("form", "concept_id", F.lit("MultiSelect").alias("type"))
    return _first_named(_with_concept(decided, meta["concept"], "concept_id", "question", "type", "inner"), "form")


def sync_attr_cols(meta: Meta) -> DataFrame:
    """Questions of registration forms whose answers decide what a device synchronises, by role; a name is taken once."""
    wanted = meta["subject_type"].select(
        F.col("id").alias("subject_key"), *(F.col(f"sync_registration_concept_{i}").alias(f"sync{i}") for i in (1, 2))
    )
    asked = live_questions(meta).where(~F.col("section_voided")).select("form_key", "concept_key", "type")
    asked = _with_concept(asked, meta["concept"], "concept_key", "question", "type", "inner")
    rows = _registrations(meta).join(wanted, "subject_key").join(asked, "form_key")
    roles = F.array_compact(F.array(*(F.when(F.col("question.uuid") == F.col(f"sync{i}"), F.lit(f"sync{i}")) for i in (1, 2))))
    return _first_named(rows.withColumn("role", F.explode(roles)), "role")


def membership_specs(meta: Meta) -> DataFrame:
    """The pairs of a group type and a member type of its roles, for group types that a live form registers."""
    pairs = meta["group_role"].select(F.col("group_subject_type_id").alias("subject_key"), "member_subject_type_id").distinct()
    groups = _subjects(meta).where(F.col("subject.type").isin("Group", "Household")).join(_registrations(meta), "subject_key", "left_semi")
    members = _subjects(meta).select(F.col("subject_key").alias("member_subject_type_id"), F.col("subject").alias("member"))
    return (
        pairs.join(groups, "subject_key")
        .join(members, "member_subject_type_id")
        .select(
            F.concat("subject.type", F.lit("ToMember")).alias("kind"),
            F.col("subject.uuid").alias("group_uuid"),
            F.col("subject.label").alias("group"),
            F.col("member.uuid").alias("member_uuid"),
            F.col("member.label").alias("member"),
        )
        .distinct()
    )


def address_spec_rows(meta: Meta) -> DataFrame:
    """What the address table has columns for: live levels, and questions of live location forms."""
    levels = meta["address_level_type"].where(~F.col("is_voided")).select("name").distinct()
    location = meta["form"].where((F.col("form_type") == LOCATION_FORM) & ~F.col("is_voided")).select(F.col("id").alias("form_key"))
    asked = live_questions(meta).join(location, "form_key", "left_semi").select("concept_key", "type")
    questions = _with_concept(asked, meta["concept"], "concept_key", "question", "type", "inner").select(
        "question.name", "question.id", "question.uuid", "question.answer"
    )
    return levels.withColumn("level", F.lit(True)).unionByName(questions.distinct().withColumn("level", F.lit(False)), allowMissingColumns=True)


def user_subject_specs(meta: Meta) -> DataFrame:
    """Subject types for users that no live form registers."""
    users = _subjects(meta).where(F.col("subject.type") == "User")
    return users.join(_registrations(meta), "subject_key", "left_anti").select("subject.uuid", "subject.label").distinct()


def type_names(meta: Meta) -> DataFrame:
    """Names by uuid of subject types, programmes, visit types, questions."""
    parts = [
        meta[t].select(F.lit(t).alias("kind"), "uuid", "name")
        for t in ("subject_type", "program", "encounter_type", "concept")
    ]
    return reduce(DataFrame.unionByName, parts)


def sync_concepts(meta: Meta) -> DataFrame:
    """The two sync questions of each subject type, with their names."""
    names = meta["concept"].select("uuid", "name")
    rows = meta["subject_type"].select(
        F.col("uuid").alias("subject_type_uuid"),
        F.col("sync_registration_concept_1").alias("concept1_uuid"),
        F.col("sync_registration_concept_2").alias("concept2_uuid"),
    )
    for i in (1, 2):
        side = names.select(F.col("uuid").alias(f"concept{i}_uuid"), F.col("name").alias(f"concept{i}_name"))
        rows = rows.join(side, f"concept{i}_uuid", "left")
    return rows.select("subject_type_uuid", "concept1_uuid", "concept1_name", "concept2_uuid", "concept2_name")


def grouped_specs(rows: DataFrame) -> DataFrame:
    """Rows of ``form_specs`` or ``repeat_specs`` gathered to one row per table: what the table is for, and its
    ``questions`` in order of their ids, each with the group that holds it.

    ``title`` is the name a question's column is made from: with the group's name before
    it, but for questions of a repeatable group.
    """
    inside = F.col("holder").isNotNull() & (F.col("kind") != "RepeatableQuestionGroup")
    title = F.when(inside, F.concat_ws(" ", "holder.name", "question.name")).otherwise(F.col("question.name"))
    question = F.struct(
        F.col("question.id").alias("id"),
        F.coalesce("holder.id", F.lit(0)).alias("holder_id"),
        title.alias("title"),
        F.col("question.uuid").alias("uuid"),
        F.col("question.answer").alias("answer"),
        F.col("holder.uuid").alias("holder_uuid"),
        F.col("holder.name").alias("holder"),
        F.coalesce("question.voided", F.lit(False)).alias("voided"),
    )
    keys = ["mapping", "form", "kind", "parent_kind", "subject", "program", "visit", "repeat"]
    return rows.groupBy(*keys).agg(F.array_sort(F.collect_set(F.when(F.col("question").isNotNull(), question))).alias("questions"))


def table_heads(rows: DataFrame) -> DataFrame:
    """The tables of ``form_specs`` or ``repeat_specs`` rows as :func:`to_specs` names them, one row per table, and their
    ``questions``: for what reads all tables of any number of forms. Tables of unsupported types are left out.
    """
    of_repeat = F.col("kind") == "RepeatableQuestionGroup"
    type_ = F.when(F.col("kind") == REGISTRATION_FORM, F.col("subject.type")).otherwise(F.col("kind"))
    names = {"subject": F.col("subject.label"), "program": F.col("program.name"), "visit": F.col("visit.name"), "repeat": F.col("repeat.name")}
    ways = [(type_ == t, *NAMING[t]) for t in NAMING if t not in ("GroupToMember", "HouseholdToMember")]
    ways += [(of_repeat & (F.col("parent_kind") == t), *REPEAT_NAMING[t], None) for t in REPEAT_NAMING]
    name, whole = F.lit(None).cast("string"), F.lit(False)
    for fits, kind, parts, suffix in ways:
        used = [names[p] for p in parts]
        name = F.when(fits, table_name_column(used, kind, suffix)).otherwise(name)
        whole = F.when(fits, reduce(lambda a, b: a & b, [p.isNotNull() for p in used])).otherwise(whole)
    known = type_.isin(*NAMING) | of_repeat
    # as on the driver, a table that can't be named is an error
    type_ = F.when(whole, type_).otherwise(F.raise_error(F.concat(F.lit("no name for a table of mapping "), F.coalesce("mapping", F.lit("null")))))
    return grouped_specs(rows).where(known).select(
        name.alias("name"), type_.cast("string").alias("type"), F.col("subject.uuid").alias("subject_type_uuid"), F.col("program.uuid").alias("program_uuid"),
        F.col("visit.uuid").alias("encounter_type_uuid"), F.col("form").alias("form_uuid"), F.col("repeat.uuid").alias("repeat_uuid"), "questions",
    )


# --- driver side: a plan per table -------------------------------------------


def _form_table(row: Row) -> TableSpec | None:
    """The spec of one table of ``grouped_specs``; None if unsupported."""
    type_ = row["subject"]["type"] if row["kind"] == REGISTRATION_FORM else row["kind"]
    names = {"subject": row["subject"]["label"], "program": row["program"]["name"], "visit": row["visit"]["name"]}
    suffix = None
    if type_ == "RepeatableQuestionGroup":
        kind, parts = REPEAT_NAMING[row["parent_kind"]]
        names["repeat"] = row["repeat"] and row["repeat"]["name"]
        columns = base_columns(f"{type_}/{row['parent_kind']}")
    elif type_ in NAMING:
        kind, parts, suffix = NAMING[type_]
        columns = base_columns(type_)
        if type_ == "Person" and row["subject"]["allow_middle_name"]:
            columns += (ColumnSpec("middle_name", "text"),)
    else:
        return None
    seen: dict[str, ColumnSpec] = {}
    for q in row["questions"]:
        column = answer_column(q["title"], q["id"], q["answer"], q["uuid"], q["holder_uuid"], q["holder"], q["voided"])
        seen.setdefault(column.name, column)
    return TableSpec(
        name=table_name([names[p] for p in parts], kind, suffix),
        type=type_,
        subject_type_uuid=row["subject"]["uuid"],
        program_uuid=row["program"]["uuid"],
        encounter_type_uuid=row["visit"]["uuid"],
        form_uuid=row["form"],
        repeat_uuid=row["repeat"] and row["repeat"]["uuid"],
        columns=columns + tuple(seen.values()),
    )


def to_specs(rows: DataFrame) -> list[TableSpec]:
    """Specs of the tables in ``form_specs`` or ``repeat_specs`` rows; one row a table comes to the driver."""
    found = sorted(grouped_specs(rows).collect(), key=lambda r: (r["mapping"], (r["repeat"] and r["repeat"]["uuid"]) or ""))
    return [t for t in map(_form_table, found) if t is not None]


def _plus(spec: TableSpec, extra: Sequence[ColumnSpec]) -> TableSpec:
    fresh = [c for c in extra if not spec.has(c.name)]
    return spec.with_columns(*fresh)


def fixed_specs() -> list[TableSpec]:
    """Tables that every tenant has, whatever its forms."""
    return [TableSpec(name=name, type=type_, columns=base_columns(type_)) for name, type_ in FIXED_TABLES]


def _asked(row: Row, **how) -> ColumnSpec:
    return answer_column(row["name"], row["id"], row["answer"], row["uuid"], **how)


def address_spec(meta: Meta) -> TableSpec:
    rows = address_spec_rows(meta).collect()
    levels = sorted(r["name"] for r in rows if r["level"])
    questions = sorted((r for r in rows if not r["level"]), key=lambda r: r["id"])
    columns = [ColumnSpec(column_name(n), "text") for n in levels]
    columns += [ColumnSpec(column_name(f"{n} id"), "integer") for n in levels]
    columns += base_columns("Address")
    columns += [_asked(r) for r in questions]
    return TableSpec(name="address", type="Address", columns=tuple(columns))


def derive_specs(meta: Meta) -> list[TableSpec]:
    """All target tables of a tenant, in processing order.

    The parts are independent small queries, so they run side by side.
    """
    parts = {
        "forms": lambda: to_specs(form_specs(meta)),
        "repeats": lambda: to_specs(repeat_specs(meta)),
        "users": lambda: user_subject_specs(meta).collect(),
        "decisions": lambda: decision_cols(meta).orderBy("id").collect(),
        "sync": lambda: sync_attr_cols(meta).orderBy("role", "id").collect(),
        "members": lambda: membership_specs(meta).collect(),
        "address": lambda: address_spec(meta),
    }
    with ThreadPoolExecutor(len(parts)) as pool:
        found = dict(zip(parts, pool.map(lambda part: part(), parts.values())))

    forms = found["forms"] + [
        TableSpec(name=table_name([r["label"]], REGISTRATION_FORM), type="User", subject_type_uuid=r["uuid"], columns=base_columns("UserSubject"))
        for r in found["users"]
    ]
    decisions: dict[str, list[ColumnSpec]] = {}
    for r in found["decisions"]:
        decisions.setdefault(r["form"], []).append(_asked(r, voided=bool(r["voided"])))
    sync = [_asked(r, role=r["role"]) for r in found["sync"]]
    forms = [_plus(t, decisions.get(t.form_uuid, [])) for t in forms]
    forms = [t if t.type in SUBJECT_TYPES or t.is_user_subject else _plus(t, sync) for t in forms]
    members = [
        TableSpec(
            name=table_name([r["group"], r["member"]], "Registration"),
            type=r["kind"],
            group_subject_type_uuid=r["group_uuid"],
            member_subject_type_uuid=r["member_uuid"],
            columns=base_columns(r["kind"]),
        )
        for r in found["members"]
    ]
    return ordered(forms + members + [found["address"]] + fixed_specs() + found["repeats"])


def spec_counts(specs: DataFrame) -> DataFrame:
    """Number of tables by type, from table rows."""
    return specs.groupBy("type").agg(F.count(F.lit(1)).alias("tables"))
