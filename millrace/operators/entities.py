"""Fan-out of flat change records into linked entities with composite ids."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.cleanse import iso_timestamp
from millrace.functions.hashing import composite_id
from millrace.operators.merge import first_per_key
from millrace.session import stored_rows

_TEXT_FIELDS = (
    *(f"data_artifact_{p}" for p in ("source", "organization", "repository", "id")),
    *(f"data_run_{p}" for p in ("source", "organization", "pipeline", "id")),
    *(f"data_commit_{p}" for p in ("source", "organization", "repository", "sha")),
    *(f"data_deploy_{p}" for p in ("source", "id")),
    "data_origin",
    "run_start_time",
    "run_end_time",
    "uid",
    "name",
    "platform",
)
_STATUS = T.StructType(
    [T.StructField("category", T.StringType()), T.StructField("detail", T.StringType())]
)
RECORD_SCHEMA = T.StructType(
    [T.StructField(f, T.StringType()) for f in _TEXT_FIELDS] + [T.StructField("run_status", _STATUS)]
)


def _parts(group: str, *names: str) -> list[Column]:
    return [F.col(f"data_{group}_{n}") for n in names]


def _complete(records: DataFrame) -> DataFrame:
    """Records with every known field; absent ones are null."""
    for f in RECORD_SCHEMA:
        if f.name not in records.columns:
            records = records.withColumn(f.name, F.lit(None).cast(f.dataType))
    return records


def _text(*names: str) -> list[Column]:
    return [F.lit(None).cast("string").alias(n) for n in names]


_TYPES = {
    "status": _STATUS,
    "startedAt": T.TimestampType(),
    "endedAt": T.TimestampType(),
    "createdAt": T.TimestampType(),
    "number": T.IntegerType(),
    "tags": T.ArrayType(T.StringType()),
}


def _absent(name: str) -> Column:
    return F.lit(None).cast(_TYPES.get(name, T.StringType()))


def _forms() -> list[tuple[str, Column, dict[str, Column]]]:
    """(entity, id, other columns) of all that a record may hold; ids of parents are id prefixes."""
    artifact = composite_id(*_parts("artifact", "source", "organization", "repository", "id"))
    repository = composite_id(*_parts("artifact", "source", "organization", "repository"))
    build = composite_id(*_parts("run", "source", "organization", "pipeline", "id"))
    pipeline = composite_id(*_parts("run", "source", "organization", "pipeline"))
    commit = composite_id(*_parts("commit", "source", "organization", "repository", "sha"))
    deployment = composite_id(*_parts("deploy", "source", "id"))
    owner = {g: composite_id(*_parts(g, "source", "organization")) for g in ("artifact", "run")}
    origin = {"origin": F.col("data_origin")}

    def empty(*names: str) -> dict[str, Column]:
        return {n: _absent(n) for n in names}

    described = empty("name", "description", "url")
    organizations = [
        ("organization", owner[g], {
            "uid": F.col(f"data_{g}_organization"), "source": F.col(f"data_{g}_source"),
            **origin, **described,
        })
        for g in owner
    ]
    return [
        *organizations,
        ("repository", repository, {
            "uid": F.col("data_artifact_repository"), "organization": owner["artifact"],
            **origin, **described,
        }),
        ("pipeline", pipeline, {
            "uid": F.col("data_run_pipeline"), "organization": owner["run"], **origin, **described,
        }),
        ("build", build, {
            "uid": F.col("data_run_id"), "pipeline": pipeline, "status": F.col("run_status"),
            "statusCategory": F.col("run_status.category"),
            "statusDetail": F.col("run_status.detail"),
            "startedAt": iso_timestamp(F.col("run_start_time")),
            "endedAt": iso_timestamp(F.col("run_end_time")),
            **empty("createdAt", "number"), **origin, **empty("name", "url"),
        }),
        ("artifact", artifact, {
            "uid": F.col("data_artifact_id"), "build": build, "repository": repository,
            **origin, **empty("name", "type", "url", "tags"),
        }),
        ("artifact_commit_association", composite_id(artifact, commit), {
            "artifact": artifact, "commit": commit, **origin,
        }),
        ("artifact_deployment", composite_id(artifact, deployment), {
            "artifact": artifact, "deployment": deployment, **origin,
        }),
        ("deployment", deployment, {
            "uid": F.col("data_deploy_id"), "source": F.col("data_deploy_source"), **origin,
        }),
        ("application", F.col("uid"), {
            "uid": F.col("uid"), "name": F.col("name"), "platform": F.col("platform"), **origin,
        }),
    ]


def entity_rows(records: DataFrame, only: Sequence[str] | None = None) -> DataFrame:
    """All entities in one frame: ``entity``, ``id`` and every column any of them has.

    The records are read once; the order of the rows of one id is also what they carry. A record is turned into its entities in place and all of these
    meet in one shuffle, which an entity that most records name enters with one row from
    each input partition. Of several rows of one id the one with the most fields filled stays.
    """
    forms = [f for f in _forms() if only is None or f[0] in only]
    names = list(dict.fromkeys(n for _, _, fields in forms for n in fields))
    shaped = [
        F.struct(
            F.lit(entity).alias("entity"),
            key.alias("id"),
            F.struct(*[fields.get(n, _absent(n)).alias(n) for n in names]).alias("fields"),
        )
        for entity, key, fields in forms
    ]
    exploded = _complete(records).select(F.explode(F.array(*shaped)).alias("e")).select("e.*")
    rows = exploded.where("id IS NOT NULL")
    gaps = sum((F.col("fields")[n].isNull().cast("int") for n in names), F.lit(0))
    return first_per_key(rows, ["entity", "id"], [gaps, F.col("fields")]).select("entity", "id", "fields.*")


def dealt(records: DataFrame, at_once: int = 100_000) -> DataFrame:
    """The records, dealt evenly to as many tasks as leave each about ``at_once`` of them.

    A task sorts all entities of its records, some ten rows a record, and a file of a few
    megabytes may hold millions of records. They are dealt by number, not by value, so equal
    ones do not meet.
    """
    tasks = -(-records.count() // at_once)
    return records.repartition(tasks, F.monotonically_increasing_id()) if tasks > 1 else records


def fan_out(records: DataFrame, only: Sequence[str] | None = None) -> Mapping[str, DataFrame]:
    """One DataFrame per entity, keyed by ``id``.

    The records are counted and dealt to tasks first. ``entity_rows`` is written once to the
    scratch folder, a folder an entity, so that each of the frames reads its own rows only.
    """
    columns = {entity: list(fields) for entity, _, fields in _forms()}
    stored = stored_rows(entity_rows(dealt(records), only), partition_by=["entity"])
    return {
        name: stored.where(F.col("entity") == name).select("id", *columns[name])
        for name in (only or columns)
    }
