"""Model calls that outlive their job: claims, answers, and caches that are written back.

``CallLog`` keeps a long series of calls on shared storage. Prompts go out in slices of consecutive batch numbers. A
slice's claims are written first, then its calls run in the tasks that write the answers: a task holds one call (or as many as
the caller puts ``together``), and its answers are in place as soon as the task commits. A repeated task is therefore one whose answer had not been stored;
a job that dies loses the calls in flight and nothing else, and the next run asks only what has no answer. Batches are
known by number and by the digest of their prompt, so an answer to other rows never counts.

Slices that are short beside a job go out several at once, as a wave: its claims, then its calls. A wave that dies has cost batches
nobody asked an attempt, so slices with a claim that got no outcome go out alone: the one that kills its job takes no more from the others.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator
from itertools import takewhile

import pandas as pd
from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F
from pyspark.sql import types as T

from recordwell.operators.inference import (
    CAPACITY_BATCH, CONTACT_FIELDS, REPAIR_RETRIES, ZERO_FIELDS, Model, answered_capacities, ask, attribute_prompt, batches,
    capacity_prompt, checked_attributes, is_attributes, is_capacities, needs_search,
)
from recordwell.session import cut_lineage
from recordwell.sources.readers import empty, if_there
from recordwell.sources.runs import RunTable

#: A wave is doubled while it takes fewer seconds, up to so many slices.
_WAVE_SECONDS, _WAVE_SLICES = 10, 128
#: Calls put together are doubled while their tasks take fewer seconds, up to so many calls a task.
_TASK_SECONDS, _TASK_CALLS = 1, 1000

_CLAIMS = T.StructType([T.StructField("batch_id", T.LongType()), T.StructField("digest", T.StringType()), T.StructField("run", T.StringType())])
_ANSWERS = T.StructType([
    *_CLAIMS.fields, T.StructField("reply", T.StringType()), T.StructField("error", T.StringType()), T.StructField("calls", T.IntegerType()),
])


class CallLog:
    """The claims and answers in ``path``.

    ``attempts`` is how many runs may claim a batch: one whose calls fail, or whose job dies every time, is given up then.
    """

    def __init__(self, spark: SparkSession, path: str, attempts: int = 3):
        self.spark, self.path, self.attempts = spark, path, attempts

    def _read(self, name: str, schema: T.StructType) -> DataFrame:
        rows = if_there(lambda: self.spark.read.schema(schema).parquet(f"{self.path}/{name}"))
        return empty(self.spark, schema) if rows is None else rows

    def claims(self) -> DataFrame:
        return self._read("claims", _CLAIMS)

    def answers(self) -> DataFrame:
        """Every stored outcome of a call, failed ones (reply null) included."""
        return self._read("answers", _ANSWERS)

    def replies(self) -> DataFrame:
        """(batch_id, digest, run, reply): one valid reply a batch; of several the one of the least run."""
        good = self.answers().filter(F.col("reply").isNotNull())
        return good.groupBy("batch_id", "digest").agg(F.min(F.struct("run", "reply")).alias("_a")).select("batch_id", "digest", "_a.*")

    def pending(self, prompts: DataFrame) -> DataFrame:
        """(batch_id, digest, prompt) of the batches without a reply that may still be claimed."""
        return self._pending(prompts).drop("_lost")

    def _pending(self, prompts: DataFrame) -> DataFrame:
        """``pending``, and whether a claim of the batch got no outcome: ``_lost``."""
        asked = prompts.select("batch_id", F.sha2(F.col("prompt").cast("binary"), 256).alias("digest"), "prompt")
        claims = self.claims().select("batch_id", "digest", F.lit(1).alias("_claims"), F.lit(0).alias("_outcomes"), F.lit(False).alias("_replied"))
        answers = self.answers().select(
            "batch_id", "digest", F.lit(0).alias("_claims"), F.lit(1).alias("_outcomes"), F.col("reply").isNotNull().alias("_replied"))
        known = claims.unionByName(answers).groupBy("batch_id", "digest").agg(
            F.sum("_claims").alias("_claims"), F.sum("_outcomes").alias("_outcomes"), F.max("_replied").alias("_replied"))
        closed = F.col("_replied") | (F.col("_claims") >= self.attempts)
        lost = F.col("_claims") > F.col("_outcomes")
        return asked.join(known, ["batch_id", "digest"], "left").filter(~F.coalesce(closed, F.lit(False))).select(
            *asked.columns, F.coalesce(lost, F.lit(False)).alias("_lost"))

    def run(self, prompts: DataFrame, model: Model, name: str | None = None, slice_size: int = 1000, slices: int | None = None,
            retries: int = REPAIR_RETRIES, check: Callable[[str], bool] | None = None, together: int = 1) -> int:
        """Ask what is pending, ``slice_size`` batch numbers a slice, at most ``slices`` slices; returns how many slices ran.

        ``name`` marks the claims and answers of the run. A task makes about ``together`` calls: a task that dies loses the answers
        of all its calls, so more than one is for calls that are short beside a task. Then the next wave's tasks make twice as many
        while they take less than a second; one call a task stays one.
        """
        name = name or uuid.uuid4().hex
        # in order, so that a wave is read from few files
        waiting = cut_lineage(self._pending(prompts).withColumn("_slice", F.expr(f"batch_id div {slice_size}")).orderBy("batch_id"))
        sizes = waiting.groupBy("_slice").agg(F.count("*").alias("calls"), F.max("_lost").alias("lost"))
        todo = sizes.orderBy("_slice").collect()[:slices]  # a row per slice_size calls
        slots = self.spark.sparkContext.defaultParallelism
        at, width = 0, 1
        while at < len(todo):
            wave = self._wave(todo, at, width)
            own = waiting.filter(F.col("_slice").between(wave[0]["_slice"], wave[-1]["_slice"])).withColumn("run", F.lit(name))
            tasks = max(1, -(-sum(s["calls"] for s in wave) // together))
            began = time.monotonic()
            own.select(*_CLAIMS.names).write.mode("append").parquet(f"{self.path}/claims")
            claimed = time.monotonic()
            self._call(own, model, tasks, retries, check)
            ended = time.monotonic()
            if together > 1 and (ended - claimed) * slots < _TASK_SECONDS * tasks:
                together = max(together, min(2 * together, _TASK_CALLS))
            if ended - began < _WAVE_SECONDS:
                width = min(2 * width, _WAVE_SLICES)
            elif ended - began > 2 * _WAVE_SECONDS:
                width = max(1, width // 2)
            at += len(wave)
        return len(todo)

    def _wave(self, todo: list[Row], at: int, width: int) -> list[Row]:
        """The slices to go out next, ``width`` at most: one that may have killed its job, or whose batches have no second attempt, goes alone."""
        def alone(s: Row) -> bool:
            return s["lost"] or s["_slice"] is None or self.attempts < 2

        if alone(todo[at]):
            return todo[at:at + 1]
        return list(takewhile(lambda s: not alone(s), todo[at:at + width]))

    def _call(self, own: DataFrame, model: Model, tasks: int, retries: int, check: Callable[[str], bool] | None) -> None:
        def call(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                found = [ask(model, prompt, retries, check) for prompt in frame["prompt"]]
                out = frame.drop(columns="prompt")
                out["reply"] = pd.Series([reply for reply, _, _ in found], dtype="object", index=frame.index)
                out["error"] = pd.Series([error for _, error, _ in found], dtype="object", index=frame.index)
                out["calls"] = pd.Series([calls for _, _, calls in found], dtype="int32", index=frame.index)
                yield out

        # the second algorithm puts a task's file in place when the task commits, not when the job does
        spread = own.select(*_CLAIMS.names, "prompt").repartition(tasks, "batch_id")
        spread.mapInPandas(call, _ANSWERS).write.mode("append").option(
            "mapreduce.fileoutputcommitter.algorithm.version", "2").parquet(f"{self.path}/answers")


#: What a cache of attribute searches holds; the key is ``cache_key``.
ATTRIBUTES = T.StructType([
    T.StructField("ask", T.StringType()), *[T.StructField(f, T.StringType()) for f in CONTACT_FIELDS],
    *[T.StructField(f, T.IntegerType()) for f in ZERO_FIELDS], T.StructField("source_quality", T.StringType()),
])


def cache_key(name: Column, city: Column) -> Column:
    """The key of a search: name and city as one text; a missing one is told apart from an empty one."""
    return F.to_json(F.array(name, city))


def search_cached(rows: DataFrame, store: RunTable, log: CallLog, model: Model | None, id_col: str = "id", **run) -> DataFrame:
    """Attributes of the rows that lack at least two: (id, address, phone, email, website, beds), from the store or the model.

    The store (a ``RunTable`` of ``ATTRIBUTES``) answers first, whatever is missing. What it does not know and lacks enough is asked
    once per name and city, through ``log``; checked answers are written back as one run, so the next search finds them.
    """
    fields = [*CONTACT_FIELDS, *ZERO_FIELDS]
    missing, enough = needs_search()
    keyed = cut_lineage(rows.select(
        id_col, "name", "city", missing.alias("_missing"), enough.alias("_enough"), cache_key(F.col("name"), F.col("city")).alias("ask")))
    known = cut_lineage(store.lookup(keyed.select("ask")))
    if model is not None:
        unknown = keyed.filter("_enough").join(known.select("ask"), "ask", "left_anti")
        questions = cut_lineage(unknown.groupBy("ask").agg(
            F.min_by(F.struct("name", "city", "_missing"), id_col).alias("_q"), F.min(id_col).cast("long").alias("batch_id")))
        prompts = questions.select("batch_id", attribute_prompt(F.col("_q.name"), F.col("_q.city"), F.col("_q._missing")).alias("prompt"))
        log.run(prompts, model, check=is_attributes, **run)
        digests = prompts.select("batch_id", F.sha2(F.col("prompt").cast("binary"), 256).alias("digest"))
        found = questions.select("ask", "batch_id").join(digests, "batch_id").join(log.replies(), ["batch_id", "digest"])
        fresh = cut_lineage(found.select("ask", checked_attributes(F.col("reply")).alias("_a")).select("ask", "_a.*"))
        store.append(fresh)
        known = known.unionByName(fresh)
    answered = known.select(F.col("ask").alias("_ask"), *fields)
    return keyed.select(id_col, "ask").join(answered, F.col("ask") == F.col("_ask")).select(id_col, *fields)


def capacity_logged(rows: DataFrame, log: CallLog, model: Model | None, id_col: str = "id", size: int = CAPACITY_BATCH, **run) -> DataFrame:
    """Estimates by facility id as ``capacity_estimates`` gives them, through ``log``: what an earlier run was told is not asked again."""
    batched = cut_lineage(batches(rows.select(id_col, "name", "type"), [id_col, "name", "type"], id_col, size))
    prompts = batched.select("batch_id", capacity_prompt(F.col("records")).alias("prompt"))
    if model is not None:
        log.run(prompts, model, check=is_capacities, **run)
    digests = prompts.select("batch_id", F.sha2(F.col("prompt").cast("binary"), 256).alias("digest"))
    return answered_capacities(log.replies().join(digests, ["batch_id", "digest"], "left_semi"), batched, id_col)
