"""Problem 6: exact ids against the tokenizers library, and the exact round trip."""

import os
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from leasemill.llm import bpe, encode

if not os.path.exists(bpe.DEFAULT_FILE):
    pytest.skip("no vocabulary files here", allow_module_level=True)


@pytest.fixture(scope="module")
def ours():
    return bpe.ByteBPE(bpe.read_file())


@pytest.fixture(scope="module")
def theirs():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(bpe.DEFAULT_FILE)
    t.encode_special_tokens = True
    return t


def same(ours, theirs, texts):
    ids, offsets = ours.encode_all(texts)
    wanted = theirs.encode_batch([t or "" for t in texts], add_special_tokens=False)
    for i, t in enumerate(texts):
        assert ids[offsets[i] : offsets[i + 1]].tolist() == wanted[i].ids, repr(t)[:200]
    data, ends = ours.decode_all(ids, offsets)
    raw = data.tobytes()
    assert [raw[a:z].decode() for a, z in zip(ends, ends[1:])] == [t or "" for t in texts]
    assert ours.count_all(texts).tolist() == [len(w.ids) for w in wanted]


TEXTS = [
    None, "", " ", "\n\n\t ", "a", "The tenant shall pay.", "don't we're I'LL", "<|endoftext|> and <|startoftext|>", "يبلغ مبلغ التأمين", "日本語の文", "😀👨‍🔧", "éèàüß", "\x00\x01\xff",
    "a" * 20_000, "ab" * 9_000, " " * 5_000, "=" * 7_777, "اب" * 4_000, "9" * 1_000, "x" * 3 + " " * 3 + "y", "１２３ Ⅷ ½",
]


def test_fixed_texts(ours, theirs):
    same(ours, theirs, TEXTS)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=60), st.text(alphabet="abcdeé ا'😀1", max_size=60)), max_size=5))
def test_any_texts(ours, theirs, texts):
    same(ours, theirs, texts)


def test_long_runs_of_few_letters(ours, theirs):
    random.seed(4)
    same(ours, theirs, ["".join(random.choices(a, k=random.randint(1, 300))) for a in ("ab", "the ", "in", "aAbB", "er", "نا", "éè") for _ in range(60)])


def test_memory_does_not_change_ids(ours, monkeypatch):
    before = ours.encode("The quick brown fox")
    monkeypatch.setattr(bpe, "MOST_REMEMBERED", 0)
    assert ours.encode_all(["The quick brown fox"])[0].tolist() == before


def test_files_that_are_refused(tmp_path):
    big = tmp_path / "big"
    with open(big, "wb") as f:
        f.truncate(bpe.MOST_FILE_BYTES + 1)
    with pytest.raises(ValueError, match="larger"):
        bpe.read_file(str(big))
    bad = b'{"model": {"vocab": {"a": 0, "b": 5, "ab": 1}, "merges": ["a b"]}}'
    with pytest.raises(ValueError, match="order"):
        bpe.ByteBPE(bad)
    import json

    spec = json.loads(bpe.read_file())
    for other in ({"normalizer": {"type": "NFC"}}, {"pre_tokenizer": {"type": "Whitespace"}}, {"pre_tokenizer": None}, {"pre_tokenizer": bpe.SPLIT | {"add_prefix_space": True}}):
        with pytest.raises(ValueError, match="another"):
            bpe.ByteBPE(json.dumps(spec | other).encode())


def test_frames(spark, theirs):
    rows = [(i % 7 if i % 5 else None, t, "clash", 1) for i, t in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, _text_ string, ids int")
    out = encode.encode(df)
    assert out.columns == ["doc_id", "ids"] and dict(out.dtypes)["ids"] == "array<int>"
    got = out.collect()
    assert sorted((r.doc_id or -1, r.ids) for r in got) == sorted((d or -1, theirs.encode(t or "", add_special_tokens=False).ids) for d, t, *_ in rows)
    back = sorted(r.text for r in encode.decode(out).collect())
    assert back == sorted(t or "" for t in TEXTS)
    assert encode.encode(df.filter("false")).count() == 0
    nothing = spark.createDataFrame([(1, None), (2, [])], "doc_id bigint, ids array<int>")
    assert {r.doc_id: r.text for r in encode.decode(nothing).collect()} == {1: None, 2: ""}
    with pytest.raises(ValueError, match="named"):
        encode.encode(df, key="ids")


def test_counts(spark, theirs):
    df = spark.createDataFrame([(1, "one two"), (1, "one two"), (2, None)], "doc_id bigint, text string").coalesce(1)
    rows = encode.token_counts(df, ["doc_id"]).collect()
    assert [(r.doc_id, r.n_tokens, r._at) for r in rows] == [(1, 2, 0), (1, 2, 1), (2, 0, 2)]
