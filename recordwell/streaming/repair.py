"""The repair loop as a stream: rows that arrive without a region are asked about until they are settled.

State holds the rows that wait and how often each was asked. A row leaves it when a reply names an action
for it, or when it was asked ``attempts`` times. Rows wait in groups of neighbouring ids, so a call asks for
several; rows of a group that were asked equally often share a call. What becomes of a row therefore depends on
its group and its attempts, not on the file it came in.

A micro-batch that is repeated loads the state it began with and overwrites its own folder, so a lost executor or
a stopped job costs calls, never a row. State grows with the rows that wait, not with those that were settled.

Defined results: rows with a region and rows without an id are not asked about. Of several waiting rows of one id the
last to arrive is asked about; an id that comes back after it was settled is asked about again, and its latest
outcome counts.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from recordwell.operators.fill import apply_actions
from recordwell.operators.inference import REGIONS, REPAIR_BATCH, REPAIR_RETRIES, Model, is_actions
from recordwell.sources.readers import empty, if_there

#: One settled row: what the reply said, how it ended and how often the model was asked.
OUTCOME = "id long, city string, region string, province string, action string, status string, attempts int"

# The actions a reply may name and what a row is then; any other action leaves the row waiting.
ENDS = {"UPDATE": "REPAIRED", "DELETE": "DELETED", "KEEP": "KEPT"}
GIVEN_UP = "GIVEN_UP"


def round_prompt(records: list[dict], asked: int) -> str:
    """Prompt for rows that were asked about ``asked`` times before."""
    again = f"{asked} earlier replies gave no action for these rows.\n" if asked else ""
    return (
        "Repair rows of a places table. For each row: an address becomes its city, an invalid name gets action DELETE, "
        "a valid city gets its official region and province with action UPDATE, a row to leave as it is gets KEEP. "
        "Regions: " + ", ".join(REGIONS) + ".\nReply with a JSON array of {id, city, region, province, action} only.\n"
        + again + "ROWS:\n" + json.dumps(records, ensure_ascii=False)
    )


def _text(value: object) -> str | None:
    return None if value is None else str(value)


def settle(waiting: dict[int, list], model: Model, attempts: int) -> list[tuple]:
    """Ask once about every waiting row (id -> [city, times asked]); return the settled rows and keep the others."""
    settled = []
    for asked in sorted({n for _, n in waiting.values()}):
        ids = sorted(i for i, (_, n) in waiting.items() if n == asked)
        try:
            reply = model(round_prompt([{"id": i, "city": waiting[i][0]} for i in ids], asked))
            actions = json.loads(reply) if is_actions(reply) else []
        except Exception:  # the model is foreign code; a failed call is an attempt without a reply
            actions = []
        told = {a["id"]: a for a in actions if a["action"] in ENDS}  # the last action of an id counts
        for i in ids:
            city = waiting[i][0]
            action = told.get(i)
            if action:
                settled.append((i, _text(action.get("city")), _text(action.get("region")), _text(action.get("province")),
                                action["action"], ENDS[action["action"]], asked + 1))
            elif asked + 1 >= attempts:
                settled.append((i, city, None, None, None, GIVEN_UP, asked + 1))
            else:
                waiting[i] = [city, asked + 1]
                continue
            del waiting[i]
    return settled


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def repair_stream(
    spark: SparkSession, source: str, schema: T.StructType, target: str, checkpoint: str, model: Model,
    id_col: str = "id", attempts: int = REPAIR_RETRIES, size: int = REPAIR_BATCH, files_per_batch: int | None = None,
) -> StreamingQuery:
    """Start the loop over the Parquet files of ``source``; each micro-batch writes its settled rows under ``target``.

    ``checkpoint`` (and the folder ``<checkpoint>-starts`` beside it) and ``target`` must be shared storage on a cluster.
    ``drain`` waits until no row waits.
    """
    columns = [f.split(" ")[0] for f in OUTCOME.split(", ")]

    def ask_group(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = json.loads(state.get[0]) if state.exists else {}
        waiting = {int(i): v for i, v in held.items()}
        for frame in frames:
            for i, city in zip(frame["id"].tolist(), frame["city"].tolist()):
                waiting[int(i)] = [city, waiting[int(i)][1] if int(i) in waiting else 0]
        settled = settle(waiting, model, attempts)
        if waiting:
            state.update((json.dumps(waiting),))
            state.setTimeoutDuration(1)  # the next micro-batch asks again, with new files or without
        elif state.exists:
            state.remove()
        yield pd.DataFrame(settled, columns=columns).astype({"id": "int64", "attempts": "int32"})

    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    # a stream without new files runs no batch, even if rows wait from an earlier run: each start brings a row that wakes it
    starts = f"{checkpoint}-starts"
    spark.createDataFrame([(None,) * len(schema)], _nullable(schema)).write.mode("append").parquet(starts)
    wake = spark.readStream.schema(_nullable(schema)).parquet(starts)
    key = F.col(id_col).cast("long")
    dirty = reader.parquet(source).unionByName(wake).filter(F.col("region").isNull() & key.isNotNull()).select(
        key.alias("id"), "city", F.floor(key / size).alias("_group"))
    settled = dirty.groupBy("_group").applyInPandasWithState(
        ask_group, OUTCOME, "waiting string", "update", GroupStateTimeout.ProcessingTimeTimeout)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    return (
        settled.writeStream.foreachBatch(write).outputMode("update").option("checkpointLocation", checkpoint)
        .trigger(processingTime="0 seconds").start()
    )


def drain(query: StreamingQuery, pause: float = 0.1) -> None:
    """Stop the stream once every file was read and no row waits any more; an error of the stream is raised."""
    while query.isActive:
        recent = query.recentProgress
        # the first batch of a run may be one that is repeated: it has not looked for new files
        if recent and recent[-1]["batchId"] > recent[0]["batchId"] and not recent[-1]["numInputRows"] and not any(
                op["numRowsTotal"] for op in recent[-1]["stateOperators"]):
            break
        time.sleep(pause)
    query.stop()
    if query.exception():
        raise query.exception()


def outcomes(spark: SparkSession, target: str) -> DataFrame:
    """One row per settled id: its latest outcome."""
    schema = T.StructType.fromDDL(OUTCOME)
    found = if_there(lambda: spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.LongType())])).parquet(target))
    if found is None:
        return empty(spark, schema)
    latest = found.groupBy(F.col("id").alias("_id")).agg(F.max_by(F.struct(*schema.names), "batch").alias("_o"))
    return latest.select("_o.*")


def repaired(rows: DataFrame, settled: DataFrame, id_col: str = "id") -> DataFrame:
    """The rows with their outcomes applied; rows that have a region stay as they are, whatever a reply says."""
    dirty = F.col("region").isNull()
    applied = apply_actions(rows.filter(dirty), settled.withColumnRenamed("id", id_col) if id_col != "id" else settled, id_col)
    return applied.unionByName(rows.filter(~dirty))
