"""Problem 4: records against a parser that goes character by character."""

import random
import re
from datetime import date

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from leasemill.operators import parse as P

GOOD = 'C1,New,01-02-2024,31-01-2025,1000.5,2000,Residential,"Tower, ""A""\nB",Hills,75.25,Person,3'


def fields_of(line):
    """The fields of a record, or None where its quoting is broken."""
    out, i = [], 0
    while True:
        if line[i : i + 1] == '"':
            j, text = i + 1, ""
            while True:
                k = line.find('"', j)
                if k < 0:
                    return None
                text += line[j:k]
                if line[k + 1 : k + 2] == '"':
                    text, j = text + '"', k + 2
                    continue
                i = k + 1
                break
            if i < len(line) and line[i] != ",":
                return None
        else:
            k = line.find(",", i)
            text = line[i:] if k < 0 else line[i:k]
            if '"' in text:
                return None
            i += len(text)
        out.append(text)
        if i >= len(line):
            return out
        i += 1


def reason_of(line):
    line = line or ""
    line = line.removeprefix("﻿").removesuffix("\r")
    fields = fields_of(line)
    if fields is None:
        return "quoting"
    if len(fields) != 12:
        return "column_count"

    def number(t):
        t = t.strip()
        return t in ("", "null", "NULL") or re.fullmatch(r"-?[0-9]+(\.[0-9]+)?", t)

    if not number(fields[4]):
        return "annual_amount"
    if not number(fields[9]):
        return "actual_area"
    t = fields[2].strip()
    if t not in ("", "null", "NULL"):
        m = re.fullmatch(r"([0-9]{2})-([0-9]{2})-([0-9]{4})", t)
        try:
            date(int(m[3]), int(m[2]), int(m[1]))
        except (TypeError, ValueError):
            return "contract_start_date"
    return None


def reasons(lines):
    return P.parse_lines(pa.array(lines, pa.string()))[0].to_pylist()


def with_field(i, text):
    f = ["C1", "New", "01-02-2024", "31-01-2025", "1000.5", "2000", "R", "T", "H", "75.25", "P", "3"]
    f[i] = text
    return ",".join(f)


LINES = [
    GOOD, GOOD + "\r", "﻿" + GOOD, None, "", " ", "\r", "﻿", ",,,,", ",,,,,,,,,,,", GOOD + ",", 'a"b' + GOOD, GOOD.replace('"A""', '"A"'), '"' + GOOD,
    with_field(1, '"New" x'), with_field(1, ' "New"'), with_field(1, '"Ne,w"'), with_field(1, '""'), with_field(1, '"'), with_field(7, "a\nb"), with_field(7, "a\r\nb"), with_field(7, "\n"),
    *(with_field(4, x) for x in ("1e5", "5.", ".5", "-3", "- 3", "+3", " 12 ", " 7", "null", "NULL", "Null", "nil", "", " ", "٥", "1,2", "NaN", "00012", "9" * 400, "1.5.2")),
    *(with_field(9, x) for x in ("x", '"1,430.5"', "-1.0")),
    *(with_field(2, x) for x in ("30-02-2024", "29-02-2024", "29-02-2023", "1-2-2024", "01/02/2024", "2024-02-01", "00-01-2024", "01-13-2024", "01-01-0000", "01-01-0001", " 01-02-2024 ", "01-02-24", "null")),
    with_field(7, "x" * 100_000), with_field(7, "日本語 é 😀"), with_field(7, "a\x00b"), "\t".join("abcdefghijkl"), "a;b;c",
]


def test_reasons():
    assert reasons(LINES) == [reason_of(x) for x in LINES]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet='a1",\n\r﻿ -.é', max_size=30), st.sampled_from([x for x in LINES if x])), max_size=12))
def test_reasons_of_any_lines(lines):
    assert reasons(lines) == [reason_of(x) for x in lines]


def test_broken_variants_of_a_record():
    random.seed(5)
    lines = []
    for _ in range(3000):
        s = list(GOOD)
        for _ in range(random.randint(1, 3)):
            i = random.randrange(len(s))
            s[i] = random.choice(['"', ",", "", "\n", " ", "x", s[i] * 2])
        lines.append("".join(s))
    assert reasons(lines) == [reason_of(x) for x in lines]


def test_pieces(monkeypatch):
    monkeypatch.setattr(P, "PIECE_BYTES", 100)
    assert reasons(LINES) == [reason_of(x) for x in LINES]


SCHEMA = "raw_id bigint, line string, reason int, line_number string"


def test_typed_rows(spark):
    df = spark.createDataFrame([(1, GOOD, 7, "k"), (2, None, 7, "k"), (3, GOOD, 7, "k"), (3, GOOD, 7, "k"), (4, with_field(11, "x"), 7, None)], SCHEMA)
    out = P.parse_records(df, keep=("raw_id", "line_number"))
    good = P.valid_rows(out).orderBy("raw_id").collect()
    assert [r.raw_id for r in good] == [1, 3, 3, 4] and good[0].raw_line_number == "k"
    r = good[0]
    assert (r.contract_start_date, r.annual_amount, r.actual_area, r.line_number, r.project_name_en) == (date(2024, 2, 1), 1000.5, 75.25, 3, 'Tower, "A"\nB')
    assert good[3].line_number is None
    assert [(r.raw_id, r.reason) for r in P.rejects(out).collect()] == [(2, "column_count")]
    assert P.parse_records(df.filter("false")).count() == 0


@pytest.mark.parametrize("n", [0, 1])
def test_tiny_batches(n):
    reason, columns = P.parse_lines(pa.array([GOOD] * n, pa.string()))
    assert len(reason) == n and all(len(c) == n for c in columns)


def test_integers_of_64_bits():
    import pyarrow as pa

    from leasemill.operators.parse import _integer

    texts = {"1234567890123456789": 1234567890123456789, str(2**63 - 1): 2**63 - 1, str(2**63): None, str(-(2**63)): -(2**63), str(-(2**63) - 1): None, "0" * 30 + "12": 12, "-00": 0, "9" * 40: None, " 7\t": 7, "-": None, "1.5": None, "": None}
    assert _integer(pa.array([*texts, None])).to_pylist() == [*texts.values(), None]
