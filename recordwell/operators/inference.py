"""Batch inference: rows to prompts, prompts to a model, replies to checked records.

The model is any plain ``prompt -> reply`` function, called inside Spark tasks. Only
that call runs in Python; prompts, parsing, checks and merges are native expressions.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from recordwell.functions.messages import missing_fields, parse_actions, parse_attributes, parse_capacity, records_json
from recordwell.functions.text import valid_beds, valid_email, valid_phone, valid_website
from recordwell.operators.fill import apply_actions
from recordwell.operators.keys import batch_of, dense_id
from recordwell.session import cut_lineage

Model = Callable[[str], str]

#: Fields an attribute search can find, and those of them that count as blank when zero.
CONTACT_FIELDS = ("address", "phone", "email", "website")
ZERO_FIELDS = ("beds",)

# Batch sizes and retries of the three kinds of call.
REPAIR_BATCH = 20
CAPACITY_BATCH = 10
REPAIR_RETRIES = 3

#: The error of a call whose replies did not pass their check.
INVALID = "invalid reply"

# The regions a repair may name.
REGIONS = (
    "Tanger-Tétouan-Al Hoceïma", "Oriental", "Fès-Meknès", "Rabat-Salé-Kénitra",
    "Béni Mellal-Khénifra", "Casablanca-Settat", "Marrakech-Safi", "Drâa-Tafilalet",
    "Souss-Massa", "Guelmim-Oued Noun", "Laâyoune-Sakia El Hamra", "Dakhla-Oued Ed-Dahab",
)


def batches(rows: DataFrame, columns: Sequence[str], order_by: str, size: int) -> DataFrame:
    """``size`` consecutive rows per batch: batch_id and the records, in order."""
    numbered = dense_id(rows, [order_by], "_n")
    return (
        numbered.groupBy(batch_of("_n", size).alias("batch_id"))
        .agg(F.array_sort(F.collect_list(F.struct("_n", F.struct(*columns).alias("r")))).alias("_rows"))
        .select("batch_id", F.transform("_rows", lambda x: x["r"]).alias("records"))
    )


def repair_prompt(records: Column) -> Column:
    """Prompt asking for one action per record."""
    return F.concat(
        F.lit(
            "Repair rows of a places table. For each row: an address becomes its city, an invalid "
            "name gets action DELETE, a valid city gets its official region and province with "
            "action UPDATE. Regions: " + ", ".join(REGIONS) + ".\n"
            "Reply with a JSON array of {id, city, region, province, action} only.\nROWS:\n"
        ),
        records_json(records),
    )


def capacity_prompt(records: Column) -> Column:
    """Prompt asking for service, equipment and bed counts per facility."""
    lines = F.array_join(F.transform(records, lambda r: F.format_string(
        "- ID %s: '%s' (Type: %s)", r["id"].cast("string"), r["name"], r["type"])), "\n")
    return F.concat(
        F.lit(
            "Estimate services, equipment items and beds of each facility. University or regional: "
            "10-20, 15-50, 300-800; clinic: 5-12, 5-20, 30-150; local: 1-5, 1-5, 10-60.\n"
            'Reply with JSON {"hospitals": [{id, service_count, equipment_count, beds}]} only.\nFACILITIES:\n'
        ),
        lines,
    )


def attribute_prompt(name: Column, city: Column, missing: Column) -> Column:
    """Prompt asking for the missing attributes of one facility."""
    return F.concat(
        F.lit("Find the missing attributes of this facility.\nName: "), F.coalesce(name, F.lit("")),
        F.lit("\nCity: "), F.coalesce(city, F.lit("")),
        F.lit("\nMissing: "), F.array_join(missing, ", "),
        F.lit("\nReply with JSON {address, phone, email, website, beds, source_quality} only."),
    )


def _json(reply: str) -> object:
    try:
        return json.loads(reply)
    except (TypeError, ValueError):
        return None


def is_actions(reply: str) -> bool:
    """A JSON array whose every item is an object with an id and an action."""
    items = _json(reply)
    return isinstance(items, list) and all(
        isinstance(i, dict) and i.get("id") is not None and i.get("action") is not None for i in items)


def is_capacities(reply: str) -> bool:
    """A JSON object with an array of facilities."""
    found = _json(reply)
    return isinstance(found, dict) and isinstance(found.get("hospitals"), list)


def is_attributes(reply: str) -> bool:
    """A JSON object; one without any attribute says that nothing was found."""
    return isinstance(_json(reply), dict)


def ask(model: Model, prompt: str, retries: int, check: Callable[[str], bool] | None) -> tuple[str | None, str | None, int]:
    """(reply, error, calls made): calls are repeated until a reply passes, at most ``retries`` in all."""
    error = None
    for n in range(1, max(1, retries) + 1):
        try:
            reply = model(prompt)
            if check is None or check(reply):
                return reply, None, n
            error = INVALID
        except Exception as problem:  # the model is foreign code; its failure is data
            error = f"{type(problem).__name__}: {problem}"
    return None, error, n


def run_model(prompts: DataFrame, model: Model, key: str = "batch_id", retries: int = REPAIR_RETRIES,
              parallel: int | None = None, check: Callable[[str], bool] | None = None) -> DataFrame:
    """Call the model once per row of (key, prompt): (key, reply, error).

    A call that fails, or whose reply does not pass ``check``, is repeated: at most ``retries``
    calls in all; then the reply is null and the error says why. ``parallel`` says how many calls run at once (default: one per
    core); prompts are small, so without it few tasks would make all the calls. Write
    the result before using it twice, or a lost executor calls again.
    """
    kind = prompts.schema[key].dataType.simpleString()

    def call(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            answers = [ask(model, p, retries, check) for p in frame["prompt"]]
            yield pd.DataFrame({
                key: frame[key],
                "reply": pd.Series([a for a, _, _ in answers], dtype="object"),
                "error": pd.Series([e for _, e, _ in answers], dtype="object"),
            })

    calls = prompts.select(key, "prompt")
    calls = calls.repartition(parallel or calls.sparkSession.sparkContext.defaultParallelism)
    return calls.mapInPandas(call, f"{key} {kind}, reply string, error string")


def reply_actions(replies: DataFrame) -> DataFrame:
    """Action records of the valid replies, in reply order; an invalid reply gives none."""
    actions = replies.select(F.posexplode(parse_actions("reply")).alias("position", "a"))
    return actions.select("position", "a.*")


def repair_once(df: DataFrame, model: Model, id_col: str = "id", size: int = REPAIR_BATCH,
                parallel: int | None = None) -> DataFrame:
    """One pass over every row without a region: batch, ask, check, apply."""
    dirty = cut_lineage(df.filter(F.col("region").isNull()).select(id_col, "city"))
    prompts = batches(dirty, [id_col, "city"], id_col, size).select(
        "batch_id", repair_prompt(F.col("records")).alias("prompt")
    )
    replies = cut_lineage(run_model(prompts, model, parallel=parallel, check=is_actions))
    # a reply may name rows that nobody asked about: those stay as they are
    asked = reply_actions(replies).join(dirty.select(F.col(id_col).alias("_asked")), F.col("id") == F.col("_asked"), "left_semi")
    return apply_actions(df, asked, id_col, order_by="position")


def repair_until_clean(df: DataFrame, model: Model, max_rounds: int = 3, **options) -> tuple[DataFrame, int]:
    """Repeat ``repair_once`` until no row lacks a region or rounds run out; a bad round may be followed by a good one.

    Returns the table and the rows still without a region.
    """
    left = df.filter(F.col("region").isNull()).count()
    for _ in range(max_rounds):
        if left == 0:
            break
        df = cut_lineage(repair_once(df, model, **options))
        left = df.filter(F.col("region").isNull()).count()
    return df, left


def needs_search(fields: Sequence[str] = CONTACT_FIELDS, zero: Sequence[str] = ZERO_FIELDS,
                 least: int = 2) -> tuple[Column, Column]:
    """(names of the missing fields, whether enough are missing to search)."""
    missing = missing_fields(tuple(fields), tuple(zero))
    return missing, F.size(missing) >= least


def checked_attributes(reply: Column) -> Column:
    """Attributes of a reply with every field validated."""
    found = parse_attributes(reply)
    return F.struct(
        found["address"].alias("address"),
        valid_phone(found["phone"]).alias("phone"),
        valid_email(found["email"]).alias("email"),
        valid_website(found["website"]).alias("website"),
        valid_beds(found["beds"]).alias("beds"),
        found["source_quality"].alias("source_quality"),
    )


def search_attributes(rows: DataFrame, cache: DataFrame | None, model: Model | None, id_col: str = "id",
                      parallel: int | None = None) -> DataFrame:
    """Attributes found for rows lacking at least two, from the cache or the model: (id, attributes).

    The cache is keyed by (name, city) and answers first, whatever is missing; of several cached rows
    of one key the greatest counts.
    Rows sharing a name and city are asked once.
    """
    fields = [*CONTACT_FIELDS, *ZERO_FIELDS]
    missing, enough = needs_search()
    keyed = rows.withColumn("_ask", F.struct(F.col("name"), F.col("city")))
    hits = None
    if cache is not None:
        known = cache.select(
            F.struct(F.col("name"), F.col("city")).alias("_cached"),
            F.struct(*[F.col(f).alias(f"_{f}") for f in fields]).alias("_row"),
        ).groupBy("_cached").agg(F.max("_row").alias("_row")).select("_cached", "_row.*")
        held = F.col("_ask") == F.col("_cached")
        hits = keyed.join(known, held).select(id_col, *[F.col(f"_{f}").alias(f) for f in fields])
        keyed = keyed.join(known.select("_cached"), held, "left_anti")
    if model is None:
        return hits if hits is not None else rows.select(id_col, *fields).limit(0)
    asked = keyed.filter(enough).withColumn("_missing", missing)
    questions = asked.groupBy("_ask").agg(F.min_by("_missing", id_col).alias("_missing"), F.min(id_col).alias("call_id"))
    prompts = questions.select(
        "call_id", attribute_prompt(F.col("_ask.name"), F.col("_ask.city"), F.col("_missing")).alias("prompt")
    )
    replies = cut_lineage(run_model(prompts, model, key="call_id", parallel=parallel, check=is_attributes))
    # what got garbage only, however often it was asked, is answered with nothing
    answered = questions.join(replies, "call_id").filter(F.col("reply").isNotNull() | (F.col("error") == INVALID)).select(
        F.col("_ask").alias("_answered"), checked_attributes(F.col("reply")).alias("_found")
    )
    found = asked.join(answered, F.col("_ask") == F.col("_answered")).select(
        id_col, *[F.col("_found")[f].alias(f) for f in fields]
    )
    return found if hits is None else hits.unionByName(found)


def capacity_estimates(rows: DataFrame, model: Model, id_col: str = "id", size: int = CAPACITY_BATCH,
                       parallel: int | None = None) -> DataFrame:
    """Model estimates by facility id (not by place in the reply); ids asked for only, first answer wins."""
    asked = cut_lineage(rows.select(id_col, "name", "type"))
    batched = cut_lineage(batches(asked, [id_col, "name", "type"], id_col, size))
    prompts = batched.select("batch_id", capacity_prompt(F.col("records")).alias("prompt"))
    replies = cut_lineage(run_model(prompts, model, parallel=parallel, check=is_capacities))
    return answered_capacities(replies, batched, id_col)


def answered_capacities(replies: DataFrame, batched: DataFrame, id_col: str = "id") -> DataFrame:
    """Estimates by facility id from (batch_id, reply); an answer counts only in the batch that asked for its id."""
    items = replies.select("batch_id", F.posexplode(parse_capacity("reply")).alias("position", "h"))
    owners = batched.select(F.col("batch_id").alias("_batch"), F.explode(F.col("records")[id_col]).alias("_asked"))
    own = items.join(owners, (F.col("batch_id") == F.col("_batch")) & (F.col("h.id") == F.col("_asked")), "left_semi")
    return own.groupBy(F.col("h.id").alias(id_col)).agg(
        F.min_by(F.struct("h.service_count", "h.equipment_count", "h.beds"), F.struct("batch_id", "position")).alias("_c")
    ).select(id_col, "_c.*")
