"""Rows that fail to parse: structural indexing of delimited records.

A batch of records is one byte buffer plus offsets.  Quote positions are found
with one vector comparison; the parity of the quotes seen so far inside a
record says whether a byte lies inside a quoted field.  Delimiters are the
commas of even parity, record ends the line breaks of even parity.  No Python
loop visits a row, and the pass needs no shuffle, so a record costs the same
in any partition and skew of keys is of no account.

A quote may open only at the start of a field and must close right before a
comma or the record's end; a doubled quote inside a quoted field is one quote
character.  Up to the first offence the parity agrees with what a sequential
parser would see, hence both reject the same records.

Defined results: a null record counts as a record without fields and an empty
one as one empty field, so both have a wrong column count.  Very long records
are handled whole; extra columns are carried along untouched.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUOTE, COMMA, NEWLINE, RETURN = 34, 44, 10, 13

#: The order of the fields of a submitted record; fixed values.
SUBMISSION_FIELDS = (
    "case_id",
    "applicant_name",
    "species_code",
    "home_world",
    "visa_class",
    "sponsor_id",
    "arrival_date",
    "declared_purpose",
    "risk_flags",
    "fee_status",
    "adjudication",
    "confidence",
)
FEE_STATES = ("paid", "waived", "unpaid", "unknown")
BLANKS = r"^\s+|\s+$"


def _buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and 64-bit record offsets of a string array."""
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[ends[0] : ends[-1]] if len(ends) else raw, ends - ends[0]


class StructuralIndex:
    """Quotes, delimiters and faults of a batch of records."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, delimiter: int = COMMA):
        n = len(bounds) - 1
        self.data, self.bounds = data, bounds
        quotes = np.flatnonzero(data == QUOTE)
        first = np.searchsorted(quotes, bounds)  # first quote of each record
        record = np.searchsorted(bounds, quotes, side="right") - 1
        opens = ((np.arange(len(quotes)) - first[record]) & 1) == 0
        before = data[np.maximum(quotes - 1, 0)] if len(quotes) else quotes
        after = data[np.minimum(quotes + 1, len(data) - 1)] if len(quotes) else quotes
        at_start = (quotes == bounds[record]) | (before == delimiter)
        reopens = (before == QUOTE) & (quotes > bounds[record])
        at_end = (quotes + 1 == bounds[record + 1]) | (after == delimiter) | (after == QUOTE)
        wrong = np.where(opens, ~(at_start | reopens), ~at_end)
        per_record = np.diff(first)
        self.badly_quoted = (per_record & 1).astype(bool)
        self.badly_quoted[record[wrong]] = True
        commas = np.flatnonzero(data == delimiter)
        owner = np.searchsorted(bounds, commas, side="right") - 1
        inside = ((np.searchsorted(quotes, commas) - first[owner]) & 1).astype(bool)
        self.delimiters, self.owner = commas[~inside], owner[~inside]
        self.n_fields = np.bincount(self.owner, minlength=n)[:n] + 1

    def columns(self, rows: np.ndarray, width: int) -> list[pa.Array]:
        """The unquoted fields of the records ``rows``, which all have ``width`` fields."""
        starts_of = np.searchsorted(self.owner, rows)
        cut = self.delimiters[(starts_of[:, None] + np.arange(width - 1)).ravel()].reshape(len(rows), width - 1)
        starts = np.column_stack([self.bounds[rows], cut + 1])
        ends = np.column_stack([cut, self.bounds[rows + 1]])
        out = []
        for k in range(width):
            a, b = starts[:, k], ends[:, k]
            quoted = (b > a) & (self.data[np.minimum(a, len(self.data) - 1)] == QUOTE) if len(self.data) else b > a
            values = _gather(self.data, a + quoted, b - quoted)
            out.append(pc.replace_substring(values, '""', '"') if quoted.any() else values)
        return out


def _gather(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    lengths = ends - starts
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    source = np.repeat(starts - offsets[:-1], lengths) + np.arange(offsets[-1])
    values = data[source] if len(source) else np.zeros(0, np.uint8)
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(values)).cast(pa.string())


def record_bounds(data: np.ndarray) -> np.ndarray:
    """Offsets of the records of one file's bytes: line breaks outside quotes end a record.

    The break itself (with a carriage return before it) stays outside, so the
    result has two numbers a record: where it starts and where it ends.
    """
    parity = np.cumsum(data == QUOTE) & 1
    ends = np.flatnonzero((data == NEWLINE) & (parity == 0))
    if len(data) and (not len(ends) or ends[-1] != len(data) - 1):
        ends = np.append(ends, len(data))
    starts = np.concatenate([[0], ends[:-1] + 1]).astype(np.int64) if len(ends) else np.zeros(0, np.int64)
    crlf = (ends > starts) & (data[np.maximum(ends - 1, 0)] == RETURN) if len(ends) else np.zeros(0, bool)
    return np.column_stack([starts, ends - crlf])


def split_columns(df: DataFrame, text: str, fields: Sequence[str]) -> DataFrame:
    """``df`` with ``__badly_quoted``, ``__n_fields`` and ``__fields`` (null unless sound in shape).

    Only the record text travels to Python and back beside its row's other
    columns; the parse is one map-side pass.
    """
    schema = T.StructType(
        [
            *df.schema.fields,
            T.StructField("__badly_quoted", T.BooleanType(), False),
            T.StructField("__n_fields", T.IntegerType(), False),
            T.StructField("__fields", T.StructType([T.StructField(f, T.StringType()) for f in fields]), True),
        ]
    )
    width, names = len(fields), list(fields)

    def parse(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            column = batch.column(batch.schema.get_field_index(text))
            data, bounds = _buffers(column)
            index = StructuralIndex(data, bounds)
            null = np.asarray(column.is_null())
            n_fields = np.where(null, 0, index.n_fields)
            sound = ~index.badly_quoted & (n_fields == width)
            rows = np.flatnonzero(sound)
            place = np.full(batch.num_rows, -1, np.int64)
            place[rows] = np.arange(len(rows))
            take = pa.array(np.maximum(place, 0), mask=~sound)
            parts = [c.take(take) for c in index.columns(rows, width)] if len(rows) else [pa.nulls(batch.num_rows, pa.string())] * width
            record = pa.StructArray.from_arrays(parts, names, mask=pa.array(~sound))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(index.badly_quoted), pa.array(n_fields, pa.int32()), record],
                [*batch.schema.names, "__badly_quoted", "__n_fields", "__fields"],
            )

    return df.mapInArrow(parse, schema)


def read_delimited_files(files: DataFrame, fields: Sequence[str], path: str = "path", content: str = "content") -> DataFrame:
    """Records of whole files (``spark.read.format('binaryFile')``): path, line_no, raw_line.

    Record ends come from the same quote parity, so quoted line breaks stay
    inside their record.  One file is one unit of work, as binaryFile reads it.
    """

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            for name, blob in zip(batch.column(names.index(path)), batch.column(names.index(content)), strict=True):
                data = np.frombuffer(blob.as_py() or b"", np.uint8)
                bounds = record_bounds(data)
                lines = _gather(data, bounds[:, 0], bounds[:, 1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name.as_py()] * len(lines), pa.string()), pa.array(np.arange(1, len(lines) + 1), pa.int64()), lines],
                    ["path", "line_no", "raw_line"],
                )

    return files.select(path, content).mapInArrow(scan, "path string, line_no long, raw_line string")


def submission_checks(record: str = "__fields") -> dict:
    """Reason -> condition under which a field of a well-formed record is invalid.

    Blanks around a value are ignored.  ``try_to_date`` is strict about the
    pattern and about days that do not exist; year 0000 is no year.
    """
    v = {f: F.regexp_replace(F.col(f"{record}.{f}"), BLANKS, "") for f in SUBMISSION_FIELDS}
    day = v["arrival_date"]
    is_day = day.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & ~day.startswith("0000") & F.try_to_date(day, "yyyy-MM-dd").isNotNull()
    return {
        "case_id": ~v["case_id"].rlike(r"^MIB-[0-9]{6}$"),
        "sponsor_id": ~v["sponsor_id"].rlike(r"^SPN-[0-9]{4}$"),
        "arrival_date": ~is_day,
        "fee_status": ~v["fee_status"].isin(*FEE_STATES),
    }


def judge_submissions(raw: DataFrame, text: str = "raw_line") -> DataFrame:
    """``raw`` with ``__fields`` and ``reasons`` (array, empty for a sound record)."""
    parsed = split_columns(raw, text, SUBMISSION_FIELDS)
    invalid = F.array_compact(F.array(*(F.when(bad, F.lit(name)) for name, bad in submission_checks().items())))
    reasons = (
        F.when(F.col("__badly_quoted"), F.array(F.lit("quoting")))
        .when(F.col("__n_fields") != len(SUBMISSION_FIELDS), F.array(F.lit("column_count")))
        .otherwise(invalid)
    )
    return parsed.withColumn("reasons", reasons)


def load_submissions(raw: DataFrame, text: str = "raw_line") -> tuple[DataFrame, DataFrame]:
    """(valid, rejected): typed prediction rows, and one row per rejected record with its reasons.

    The raw columns are kept in both under their own names unless a field of
    the record has the same name; then the raw column gets the suffix ``_raw``.
    """
    judged = judge_submissions(raw, text)
    keep = [F.col(c).alias(f"{c}_raw" if c in SUBMISSION_FIELDS else c) for c in raw.columns if c != text]
    typed = [F.regexp_replace(F.col(f"__fields.{f}"), BLANKS, "").alias(f) for f in SUBMISSION_FIELDS[:-1]]
    score = F.regexp_replace(F.col("__fields.confidence"), BLANKS, "").try_cast("double").alias("confidence")
    valid = judged.where(F.size("reasons") == 0).select(*keep, *typed, score)
    rejected = judged.where(F.size("reasons") > 0).select(*keep, F.col(text), "reasons")
    return valid, rejected
