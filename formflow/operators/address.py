"""The address tree as one wide table: a title and an id per level."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formflow.functions.obs import concept_map, obs_source, project_answers
from formflow.model import TableSpec

# --- fixed values -----------------------------------------------------------
ADDRESS_COLUMNS = (
    "id", "uuid", "is_voided", "created_by_id", "last_modified_by_id", "created_date_time",
    "last_modified_date_time", "organisation_id", "gps_coordinates",
)
# --- end of fixed values ----------------------------------------------------


def level_chain(types: DataFrame) -> list[tuple[int, str, int | None]]:
    """Live level types as (id, name, parent id), lowest level first.

    Level types are the handful of administrative tiers of a tenant. A type
    comes before its parent, whatever number the tenant gave to the levels.
    """
    rows = types.where(~F.col("is_voided")).select("id", "name", "parent_id").orderBy("id").collect()
    left = {r["id"]: (r["id"], r["name"], r["parent_id"]) for r in rows}
    chain = []
    while left:
        parents = {p for _, _, p in left.values()}
        lowest = [i for i in left if i not in parents]
        if not lowest:
            raise ValueError("address level types form a cycle")
        chain += [left.pop(i) for i in lowest]
    return chain


def address_rows(
    levels: DataFrame,
    types: DataFrame,
    spec: TableSpec | None = None,
    concept: DataFrame | None = None,
    concept_answer: DataFrame | None = None,
) -> DataFrame:
    """One row per address, with title and id in the columns of its level."""
    chain = level_chain(types)
    own_level = F.col("type_id")
    placed = []
    for type_id, name, _ in chain:
        placed.append(F.when(own_level == type_id, F.col("title")).alias(name))
        placed.append(F.when(own_level == type_id, F.col("id")).alias(f"{name} id"))
    rows = levels.where(own_level.isin([t for t, _, _ in chain]))
    keep = [*placed, *ADDRESS_COLUMNS]
    if spec is None or not spec.answers:
        return rows.select(*keep)
    uuids = sorted({c.concept_uuid for c in spec.answers})
    answers = concept_map(concept, concept_answer, uuids)
    return project_answers(rows, spec.answers, obs_source(spec), answers, keep)


def propagate_parents(address: DataFrame, levels: DataFrame, types: DataFrame) -> DataFrame:
    """Fill in the ancestors' titles and ids, lowest level type first.

    Every row that has an address at level L gets that address's parent in
    the columns of L's parent level, so one left join per step of the level
    chain covers the whole table and a renamed parent reaches all below it.
    """
    order = address.columns
    chain = level_chain(types)
    names = {type_id: name for type_id, name, _ in chain}
    child = levels.select("id", "type_id", "parent_id")
    parent = levels.select(F.col("id").alias("parent_id"), F.col("title").alias("_title"))
    links = child.join(parent, "parent_id")
    for type_id, name, parent_type in chain:
        if parent_type not in names:
            continue
        upper = names[parent_type]
        step = links.where(F.col("type_id") == type_id).select(
            F.col("id").alias(f"{name} id"), F.col("parent_id").alias("_id"), "_title"
        )
        address = (
            address.join(step, f"{name} id", "left")
            .withColumns(
                {
                    upper: F.coalesce("_title", F.col(f"`{upper}`")),
                    f"{upper} id": F.coalesce("_id", F.col(f"`{upper} id`")),
                }
            )
            .drop("_title", "_id")
        )
    return address.select(*[F.col(f"`{c}`") for c in order])
