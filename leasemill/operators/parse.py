"""Problem 4: raw CSV records, one to a row, into typed rows and labelled rejects in one pass without a shuffle.

Each Arrow batch is handled as vectors. Quoting is judged by one linear-time pattern over the record; records with sound
quoting go through pyarrow's CSV reader, whose invalid-row callback reports those with a wrong number of columns; all
fields are read as strings, then cast as vectors, and the first failing cell names the reason.

Defined results: one row out for each row in, repeated ones too. ``reason`` is null for a valid record, else the first that
applies of quoting, column_count, annual_amount, actual_area, contract_start_date. Null, empty and blank lines are
column_count. One carriage return at the end and a byte-order mark at the start are not part of a record. White space
around the three judged fields is ignored; empty, ``null`` and ``NULL`` are nulls, in the other fields too. In
fields that are not judged (contract_end_date, contract_amount, line_number) a value that does not cast is null. Year 0000
names no real day. Line breaks inside quotes stay in the value. Amounts too large for a double are infinite. Reject rows
have no typed fields. An empty table gives no rows; other columns are passed through only if asked for by ``keep``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.csv as pcsv
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leasemill.schema import RAW_COLUMNS
from leasemill.session import ship_package
from leasemill.settings import NULL_TOKENS

QUOTING, COLUMN_COUNT = "quoting", "column_count"
JUDGED = ["annual_amount", "actual_area", "contract_start_date"]
#: A record of fields that are quoted from their very first character to right before a comma or the end, or hold no quote.
SOUND = r'\A(?:"(?:[^"]|"")*"|[^",][^",]*|)(?:,(?:"(?:[^"]|"")*"|[^",][^",]*|))*\z'
NUMBER = r"\A-?[0-9]+(?:\.[0-9]+)?\z"
DATE = r"\A[0-9]{2}-[0-9]{2}-[0-9]{4}\z"
#: Records are given to the CSV reader in pieces of about this many bytes; a longer record makes a piece of its own.
PIECE_BYTES = 32 << 20
NULLS = pa.array(NULL_TOKENS, pa.string())
MONTH_DAYS = np.array([31, 29, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31])

_ARROW = {T.StringType(): pa.string(), T.DateType(): pa.date32(), T.DoubleType(): pa.float64(), T.LongType(): pa.int64()}


def _stand_ins(text: pa.Array) -> tuple[str, str]:
    """Two characters that do not occur in the texts, to stand for line breaks while the CSV reader has them."""
    free = []
    for code in range(0xE000, 0xF8FF):
        ch = chr(code)
        if not pc.any(pc.match_substring(text, ch)).as_py():
            free.append(ch)
            if len(free) == 2:
                return free[0], free[1]
    raise ValueError("every private-use character occurs")


def _read(text: pa.Array, positions: np.ndarray, names: list[str]) -> tuple[np.ndarray, list[pa.Array]]:
    """Soundly quoted records through the CSV reader: the positions of those with the right number of columns, and their
    fields as strings. Each record is led by its position, so that the reader's rows and its rejects keep their place."""
    rejected: list[int] = []

    def reject(row) -> str:
        rejected.append(int(row.text.partition(",")[0]))
        return "skip"

    breaks = pc.any(pc.match_substring_regex(text, r"[\r\n]")).as_py()
    if breaks:
        lf, cr = _stand_ins(text)
        text = pc.replace_substring(pc.replace_substring(text, "\n", lf), "\r", cr)
    lead = pc.cast(pa.array(positions), pa.string())
    lines = pc.binary_join_element_wise(lead, text, ",")
    buffer = ("\n".join(lines.to_pylist()) + "\n").encode("utf-8", "surrogatepass")
    table = pcsv.read_csv(
        pa.BufferReader(buffer),
        read_options=pcsv.ReadOptions(use_threads=False, block_size=min(len(buffer) + 1, 2**31 - 1), column_names=["_at", *names]),
        parse_options=pcsv.ParseOptions(delimiter=",", quote_char='"', double_quote=True, escape_char=False, newlines_in_values=False, ignore_empty_lines=False, invalid_row_handler=reject),
        convert_options=pcsv.ConvertOptions(column_types={"_at": pa.int64()} | dict.fromkeys(names, pa.string()), strings_can_be_null=False, quoted_strings_can_be_null=False, check_utf8=False),
    ).combine_chunks()
    columns = [c.chunk(0) if c.num_chunks else pa.array([], c.type) for c in table.columns]
    at, fields = columns[0].to_numpy(zero_copy_only=False), columns[1:]
    if len(at) + len(rejected) != len(positions):
        raise ValueError("the CSV reader lost records")
    if breaks:
        fields = [pc.replace_substring(pc.replace_substring(f, lf, "\n"), cr, "\r") for f in fields]
    return at, fields


def _null_tokens(values: pa.Array) -> pa.Array:
    """Without white space at the ends; the texts that stand for null become nulls."""
    trimmed = pc.utf8_trim_whitespace(values)
    return pc.if_else(pc.is_in(trimmed, value_set=NULLS), pa.scalar(None, pa.string()), trimmed)


def _number(values: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Numbers, and which texts are none."""
    text = _null_tokens(values)
    fits = pc.fill_null(pc.match_substring_regex(text, NUMBER), True)
    good = pc.if_else(fits, text, pa.scalar(None, pa.string()))
    return pc.cast(good, pa.float64()), ~fits.to_numpy(zero_copy_only=False)


def _integer(values: pa.Array) -> pa.Array:
    """Integers of 64 bits; what is none, or does not fit, is null."""
    text = _null_tokens(values)
    digits = pc.fill_null(pc.match_substring_regex(text, r"\A-?[0-9]+\z"), False)
    plain = pc.replace_substring_regex(pc.if_else(digits, text, pa.scalar(None, pa.string())), r"\A(-?)0+([0-9])", r"\1\2")
    sign, size = pc.starts_with(plain, "-"), pc.replace_substring_regex(plain, r"\A-", "")
    # Texts of equal length stand in the order of their numbers.
    length, most = pc.utf8_length(size), pc.if_else(sign, str(2**63), str(2**63 - 1))
    fits = pc.or_(pc.less(length, 19), pc.and_(pc.equal(length, 19), pc.less_equal(size, most)))
    return pc.cast(pc.if_else(pc.fill_null(fits, False), plain, pa.scalar(None, pa.string())), pa.int64())


def _day(values: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Days of the form dd-MM-yyyy, and which texts are none."""
    text = _null_tokens(values)
    there = pc.is_valid(text).to_numpy(zero_copy_only=False)
    fits = pc.fill_null(pc.match_substring_regex(text, DATE), False).to_numpy(zero_copy_only=False)
    safe = pc.if_else(pa.array(fits), text, pa.scalar("01-01-1970"))
    part = lambda a, b: pc.cast(pc.utf8_slice_codeunits(safe, a, b), pa.int64()).to_numpy(zero_copy_only=False)
    d, m, y = part(0, 2), part(3, 5), part(6, 10)
    inside = (m >= 1) & (m <= 12) & (y >= 1)
    leap = (y % 4 == 0) & ((y % 100 != 0) | (y % 400 == 0))
    longest = MONTH_DAYS[np.where(inside, m, 1) - 1] - ((m == 2) & ~leap)
    real = fits & inside & (d >= 1) & (d <= longest)
    months = np.where(real, (y - 1970) * 12 + m - 1, 0).astype("datetime64[M]")
    days = months.astype("datetime64[D]").astype(np.int64) + np.where(real, d - 1, 0)
    return pa.array(days.astype(np.int32), pa.date32(), mask=~real), there & ~real


def _pieces(lengths: np.ndarray):
    """Ranges of records of about PIECE_BYTES together."""
    ends = np.cumsum(lengths)
    start = 0
    while start < len(lengths):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + PIECE_BYTES, side="right")))
        yield start, stop
        start = stop


def parse_lines(lines: pa.Array) -> tuple[pa.Array, list[pa.Array]]:
    """The reason of each record (null: valid) and the typed columns, null for rejects."""
    n = len(lines)
    names = [c for c, _ in RAW_COLUMNS]
    reason = np.full(n, None, object)
    text = pc.fill_null(lines, "").cast(pa.string())
    text = pc.replace_substring_regex(text, r"\A\x{FEFF}", "")
    text = pc.replace_substring_regex(text, r"\r\z", "")
    sound = pc.match_substring_regex(text, SOUND).to_numpy(zero_copy_only=False)
    reason[~sound] = QUOTING
    reason[sound] = COLUMN_COUNT
    positions, parts = [], [[] for _ in names]
    where = np.flatnonzero(sound)
    lengths = pc.binary_length(text).to_numpy(zero_copy_only=False)[where] + 24
    for a, b in _pieces(lengths):
        at, fields = _read(text.take(pa.array(where[a:b])), where[a:b], names)
        positions.append(at)
        for i, f in enumerate(fields):
            parts[i].append(f)
    at = np.concatenate(positions) if positions else np.array([], np.int64)
    fields = {c: (pa.concat_arrays(parts[i]) if parts[i] else pa.array([], pa.string())) for i, c in enumerate(names)}
    reason[at] = None
    typed: dict[str, pa.Array] = {}
    failing: dict[str, np.ndarray] = {}
    for c, kind in RAW_COLUMNS:
        if kind == T.DoubleType():
            typed[c], failing[c] = _number(fields[c])
        elif kind == T.DateType():
            typed[c], failing[c] = _day(fields[c])
        elif kind == T.LongType():
            typed[c] = _integer(fields[c])
        else:
            typed[c] = pc.if_else(pc.is_in(fields[c], value_set=NULLS), pa.scalar(None, pa.string()), fields[c])
    for c in reversed(JUDGED):  # the first of them is written last
        reason[at[failing[c]]] = c
    valid = np.array([r is None for r in reason], bool) if n else np.array([], bool)
    take = np.full(n, -1, np.int64)
    take[at] = np.arange(len(at))
    take[~valid] = -1
    index = pa.array(take, mask=take < 0)
    return pa.array(reason, pa.string()), [typed[c].take(index) for c in names]


def parse_records(df: DataFrame, line: str = "line", keep: tuple[str, ...] = ("raw_id",)) -> DataFrame:
    """The columns ``keep``, ``reason``, and the typed columns of a record.

    A kept column whose name is that of a record's column comes out as ``raw_<name>``.
    """
    ship_package(df.sparkSession)
    taken = {c for c, _ in RAW_COLUMNS} | {"reason"}
    kept = [F.col(c).alias(f"raw_{c}" if c in taken else c) for c in keep]
    source = df.select(F.col(line).cast("string").alias("_line_"), *kept)
    out = T.StructType([*source.schema.fields[1:], T.StructField("reason", T.StringType()), *[T.StructField(c, t) for c, t in RAW_COLUMNS]])
    names = [f.name for f in out.fields]

    def run(batches):
        for batch in batches:
            reason, columns = parse_lines(batch.column(0))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], reason, *columns], names=names)

    return source.mapInArrow(run, out)


def rejects(parsed: DataFrame) -> DataFrame:
    """The records that did not parse, with the reason only."""
    typed = [c for c, _ in RAW_COLUMNS]
    return parsed.filter(F.col("reason").isNotNull()).drop(*typed)


def valid_rows(parsed: DataFrame) -> DataFrame:
    """The records that did, typed."""
    return parsed.filter(F.col("reason").isNull()).drop("reason")
