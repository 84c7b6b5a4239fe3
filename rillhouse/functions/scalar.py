"""Scalar column expressions: time, age, codecs, JSON validity."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from rillhouse import schemas

# Fixed text formats of the producers.
DATE_TIME = "yyyy-MM-dd HH:mm:ss"
DATE_TIME_SHAPE = "____-__-__ __:__:__"
DATE = "yyyy-MM-dd"
DATE_SHAPE = "____-__-__"

SECOND_US = 1_000_000


def micros(span: timedelta) -> int:
    return span // timedelta(microseconds=1)


def time_cell(ts: str | Column, width: timedelta) -> Column:
    """Start, in epoch microseconds, of the epoch-aligned time cell of a timestamp.

    Ordered per-key operators partition by (key, cell) instead of key alone, so a key that holds
    a large share of all rows is spread over as many tasks as its history has cells.
    """
    us = F.unix_micros(F.col(ts) if isinstance(ts, str) else ts)
    return us - F.pmod(us, F.lit(micros(width)))


def parse_time(text: str | Column) -> Column:
    """Text to timestamp; text that does not have the fixed format gives null.

    The plain cast reads this format several times faster than a format string does; the shape test
    keeps out the other notations a cast would accept.
    """
    v = F.col(text) if isinstance(text, str) else text
    return F.when(v.like(DATE_TIME_SHAPE), v).try_cast("timestamp")


def epoch_millis(text: str | Column) -> Column:
    return F.unix_millis(parse_time(text))


def time_text(ts: str | Column) -> Column:
    return F.date_format(ts, DATE_TIME)


def create_date(ts: str | Column) -> Column:
    return F.date_format(ts, DATE)


def create_hour(ts: str | Column) -> Column:
    return F.date_format(ts, "HH")


def day_of_millis(ts: str | Column) -> Column:
    return F.to_date(F.timestamp_millis(F.col(ts) if isinstance(ts, str) else ts))


def event_time(text: str | Column, record_ts: str | Column) -> Column:
    """Time given in the record, or the source's own record time where that does not parse."""
    fallback = F.col(record_ts) if isinstance(record_ts, str) else record_ts
    return F.coalesce(parse_time(text), fallback)


def age(birthday: str | Column, as_of: str | Column) -> Column:
    """Whole 365-day years between a birthday (text or date) and a given day."""
    born = (F.col(birthday) if isinstance(birthday, str) else birthday).cast("string")
    day = F.when(born.like(DATE_SHAPE), born).try_cast("date")
    return F.floor(F.datediff(as_of, day) / 365).cast("int")


def is_json_object(text: str | Column) -> Column:
    """True only where the whole text is one JSON object.

    A parser alone accepts text after a complete value. So the text is read once as the content of
    an array and once as a member value: whatever follows the first object would have to go on
    with a comma in both, and then the array has a second element. Null, empty text, arrays,
    scalars and objects with duplicate keys are not objects in this sense.
    """
    v = F.col(text) if isinstance(text, str) else text
    alone = F.json_array_length(F.concat(F.lit("["), v, F.lit("]"))) == 1
    member = F.try_parse_json(F.concat(F.lit('{"_":'), v, F.lit("}")))
    opens = F.startswith(F.ltrim(v, F.lit(" \t\r\n")), F.lit("{"))
    return F.coalesce(opens & alone & member.isNotNull(), F.lit(False))


def decode_action(value: str | Column) -> Column:
    """JSON bytes or text to the (userId, action) record."""
    v = F.col(value) if isinstance(value, str) else value
    return F.from_json(v.cast("string"), schemas.ACTION)


def encode_action(record: str | Column) -> Column:
    return F.to_json(record).cast("binary")


def text_length(value: str | Column) -> Column:
    return F.length(value)


def money(value: str | Column) -> Column:
    """Exact decimal for sums, so that the result does not depend on the order of addition."""
    v = F.col(value) if isinstance(value, str) else value
    return v.cast("decimal(18,2)")
