"""Behaviour log: strict parsing with a dirty output, splits and the entry-page predicate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillhouse import schemas
from rillhouse.functions.scalar import is_json_object

# Topic names of the detail layer.
TOPIC_PAGE = "dwd_page_log"
TOPIC_START = "dwd_start_log"
TOPIC_DISPLAY = "dwd_display_log"
TOPIC_ACTION = "dwd_action_log"
TOPIC_ERROR = "dwd_error_log"
TOPIC_DIRTY = "dwd_dirty_log"


def mark_dirty(df: DataFrame, value: str = "value") -> DataFrame:
    """Add ``dirty``: the text is not one JSON object."""
    return df.withColumn("dirty", ~is_json_object(value))


def parse_all(df: DataFrame, value: str = "value") -> DataFrame:
    """Fields of the log record, with ``dirty`` and the text as it came.

    The record passes through a generator of one row. Filters on its fields stay above that, so
    they read the parsed record; pushed below, each of them would parse the text again.
    """
    rest = [c for c in df.columns if c != value]
    clean = F.when(~F.col("dirty"), F.col(value))
    parsed = F.struct(
        "dirty",
        F.col(value),
        F.from_json(clean, schemas.BASE_LOG).alias("__r"),
    )
    rows = mark_dirty(df, value).select(*rest, F.inline(F.array(parsed)))
    return rows.select(*rest, "dirty", value, "__r.*")


def dirty_records(parsed: DataFrame, value: str = "value") -> DataFrame:
    """The raw text of dirty rows, and the source columns beside it."""
    fields = {*schemas.BASE_LOG.fieldNames(), "dirty"}
    return parsed.where("dirty").select(*[c for c in parsed.columns if c not in fields])


def clean_records(parsed: DataFrame, value: str = "value") -> DataFrame:
    return parsed.where("NOT dirty").drop(value, "dirty")


def parse_log(df: DataFrame, value: str = "value") -> DataFrame:
    """The clean records of a text input."""
    return clean_records(parse_all(df, value), value)


def is_entry(last_page_id: str | Column = "page.last_page_id") -> Column:
    """Entry page: there is no previous page."""
    col = F.col(last_page_id) if isinstance(last_page_id, str) else last_page_id
    return F.coalesce(col, F.lit("")) == ""


def start_log(logs: DataFrame) -> DataFrame:
    return logs.where(F.col("start").isNotNull())


def page_log(logs: DataFrame) -> DataFrame:
    """Every record that is not a start record."""
    return logs.where(F.col("start").isNull())


def display_log(logs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per display of a page record, with the id of its page (null without a page)."""
    shown = page_log(logs).select(
        *carry, F.col("page.page_id").alias("page_id"), F.explode("displays").alias("d")
    )
    return shown.select(*carry, "d.*", "page_id")


def action_log(logs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per action of a page record, with the id of its page."""
    done = page_log(logs).select(
        *carry, F.col("page.page_id").alias("page_id"), F.explode("actions").alias("a")
    )
    return done.select(*carry, "a.*", "page_id")


def error_log(logs: DataFrame) -> DataFrame:
    return logs.where(F.col("err").isNotNull())


def split_log(logs: DataFrame) -> dict[str, DataFrame]:
    """The five detail outputs as separate DataFrames over one input."""
    return {
        TOPIC_START: start_log(logs),
        TOPIC_PAGE: page_log(logs),
        TOPIC_DISPLAY: display_log(logs),
        TOPIC_ACTION: action_log(logs),
        TOPIC_ERROR: error_log(logs),
    }


#: Fields of a JSON object, each whole and of its own type, whatever the schema says.
_FIELDS = "MAP<STRING, VARIANT>"


def with_flag(fields: Column, flag: Column) -> Column:
    """The text of a record, given as fields, with another new-visitor flag in ``common``."""
    common = F.try_variant_get(fields["common"], "$", _FIELDS)
    put = F.map_concat(
        F.map_filter(common, lambda k, _: k != "is_new"),
        F.create_map(F.lit("is_new"), flag.cast("variant")),
    )
    changed = F.transform_values(
        fields, lambda k, v: F.when(k == "common", F.to_variant_object(put)).otherwise(v)
    )
    return F.when(common.isNotNull(), F.to_json(changed))


def with_page(fields: Column, page_id: Column) -> Column:
    """The text of an item, given as fields, with the id of its page in place of one it has."""
    rest = F.map_filter(fields, lambda k, _: k != "page_id")
    own = F.create_map(F.lit("page_id"), page_id.cast("variant"))
    return F.to_json(F.when(page_id.isNull(), rest).otherwise(F.map_concat(rest, own)))


def route_log(logs: DataFrame, value: str = "value") -> DataFrame:
    """All outputs as (topic, value) rows, in one pass over the input.

    Messages are the texts that came, with all their fields, also those that the schema does not
    name. A record whose flag was corrected, and an item that gets the id of its page, are written
    anew from their fields: nothing but that field changes, though inner objects come in the order
    of their keys and numbers in their shortest form. A broker or partitioned file sink can write
    all topics at once; the input is neither cached nor read once per output. Texts are only made
    where they are selected. Rows marked dirty, where the input has them, go to a topic of their own
    as they came.
    """
    texts = value in logs.columns
    page_id, flag = F.col("page.page_id"), F.col("common.is_new")
    dirty = F.col("dirty") if "dirty" in logs.columns else F.lit(False)
    is_start = ~dirty & F.col("start").isNotNull()
    is_page = ~dirty & F.col("start").isNull()
    parts = {TOPIC_DISPLAY: "displays", TOPIC_ACTION: "actions"}

    def one(topic: str, at: Column) -> Column:
        return F.struct(F.lit(topic).alias("__topic"), at.cast("int").alias("__at"))

    whole = {
        TOPIC_START: is_start,
        TOPIC_PAGE: is_page,
        TOPIC_ERROR: ~dirty & F.col("err").isNotNull(),
        TOPIC_DIRTY: dirty,
    }
    none = F.array().cast("array<struct<__topic:string,__at:int>>")
    marks = [
        F.filter(
            F.array(*[F.when(is_it, one(topic, F.lit(None))) for topic, is_it in whole.items()]),
            lambda m: m.isNotNull(),
        )
    ]

    def each(topic: str, items: str) -> Column:
        found = F.transform(F.col(items), lambda _, i: one(topic, i))
        return F.coalesce(F.when(is_page, found), none)

    marks += [each(topic, items) for topic, items in parts.items()]

    rows = logs
    if texts:
        # fields are read only from records that are written anew
        line = F.col(value)
        same = F.get_json_object(line, "$.common.is_new").eqNullSafe(flag) | flag.isNull()
        some = is_page & ((F.size("displays") > 0) | (F.size("actions") > 0))
        rows = logs.withColumn("__same", same).withColumn(
            "__fields", F.from_json(F.when(~dirty & (~F.col("__same") | some), line), _FIELDS)
        )
    rows = rows.select("*", F.inline(F.concat(*marks)))
    record = F.to_json(F.struct(*[F.col(n) for n in schemas.BASE_LOG.fieldNames()]))
    topic, at = F.col("__topic"), F.col("__at")
    message = None
    if texts:
        # a line end in JSON is white space; a message is one line
        came = F.translate(F.col(value), "\n\r", "  ")
        anew = with_flag(F.col("__fields"), flag)
        record = F.coalesce(F.when(F.col("__same"), came).otherwise(anew), record)
        message = F.when(topic == TOPIC_DIRTY, F.col(value))
    for name, items in parts.items():
        text = F.to_json(F.get(F.col(items), at).withField("page_id", page_id))
        if texts:
            found = F.try_variant_get(F.col("__fields")[items], "$", f"ARRAY<{_FIELDS}>")
            text = F.coalesce(with_page(F.get(found, at), page_id), text)
        is_it = topic == name
        message = F.when(is_it, text) if message is None else message.when(is_it, text)
    return rows.select(topic.alias("topic"), message.otherwise(record).alias("value"))


def dirty_rate(marked: DataFrame, *by: str | Column) -> DataFrame:
    """Share of dirty records, with both counts, per grouping."""
    return marked.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_ct"),
        F.sum(F.col("dirty").cast("long")).alias("dirty_ct"),
        F.avg(F.col("dirty").cast("double")).alias("dirty_rate"),
    )
