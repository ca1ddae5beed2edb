"""Problem 8: texts that a source cut off.

The corpus gives two things, both from positions that are not the end of a text. A vocabulary trie, held as a table of its
nodes: every prefix of a known word with the occurrences of the words below it. And, for the last words of a sentence so
far (orders 5, 3, 2, 1), how often a sentence ended there and how often it went on. A text without a closing mark is cut

- in a word, if its last word is unknown and a proper prefix of known words, or is such a prefix after words that never go
  on with it;
- in a sentence, if sentences hardly ever end at its last words; or, where the corpus has not seen these often enough, with
  the word after the words before them; the longest context seen often enough counts.

A word that other texts end with after the same words is whole, even if it occurs nowhere else (a signature, a page footer).

Length is evidence: where a source's unclosed texts pile up at one length (in characters or bytes), or where an ellipsis
or a dangling comma stands at the end, a smaller share of endings is enough. Blanks, ellipses and broken characters after
the cut are looked past.

Only texts without a closing mark are followed up. Corpus counts are combined in each task and shuffled only if their key
is among the keys asked for, which a bit array sized by the number of keys tells (a false positive costs a row of shuffle,
nothing else); more keys than one array holds are asked for in several scans. Texts are joined to what is known of their
endings with hot endings apart.

Defined results: null, empty and blank texts are no cases, nor are texts without a letter, mark or digit (only emoji, say)
unless they end with a broken character; repeated texts are judged alike and are all cases; a null source
is a source; a corpus too small to know anything flags only broken characters at the end. Whole texts are read.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leasemill.llm.encode import prepare
from leasemill.operators.bits import bit_words
from leasemill.operators.joins import LEAST_ROWS, join_facts
from leasemill.session import persist_table, small_or_stored

CLOSERS = frozenset(".!?؟。۔।॥")
PAUSES = frozenset(";؛")
HANGING = frozenset(",،-/–—([{&+=")
#: A colon ends no sentence, yet a text may end with one: a heading.
COLON = frozenset(":：")
#: Characters without a look of their own.
INVISIBLE = regex.compile(r"[\p{Cf}ـ️]+")
CORE = regex.compile(r"[\p{L}\p{M}\p{N}](?:.*[\p{L}\p{M}\p{N}])?", regex.S)
#: What stands after the last word; texts that differ in nothing else are copies of each other.
LAST_OF_WORD = regex.compile(r"(?r)[\p{L}\p{M}\p{N}]")
ASCII_MARKS, TATWEEL = "".join(chr(i) for i in range(128) if not chr(i).isalnum()), "ـ"
NINES = str.maketrans("0123456789", "9999999999")
DIGIT = regex.compile(r"\p{Nd}")
BROKEN = "�"
#: Kinds of tokens: without a word (joint, break, ellipsis, closing mark, end of the text), and words by what follows them.
JOINT, BREAK, GAP, MARK, END, PLAIN, CLOSED, COMMA, ELLIPSIS = range(9)
ORDERS = (5, 3, 2, 1)
#: Bits for each key of a bit array, the least and the most bits of one, and the most arrays, each of which takes a scan of the
#: corpus. Beyond ``MOST_ARRAYS`` of them (half a billion keys) the arrays get fuller, and more is shuffled.
BITS_A_KEY, LEAST_BITS, MOST_BITS, MOST_ARRAYS = 16, 1 << 16, 1 << 28, 16
FLUSH = 1_000_000
MOST_REMEMBERED = 500_000
START, SALTS = np.uint64(0x9E3779B97F4A7C15), {5: 11, 3: 12, 2: 13, 1: 14, "next": 15}

#: Share of endings below which a context is no place to end, without and with evidence of a cut; and the support it takes.
RARE_END, DOUBTFUL_END, SUPPORT = 0.03, 0.5, 3
#: The same with evidence where two words are all the context there is.
DOUBTFUL_END_OF_TWO = 0.8
#: A length at which at least so many different unclosed texts of a source pile up, and so many deviations above the mean
#: of the lengths around.
PILE, PILE_DEVIATIONS, NEIGHBOURS = 5, 4.0, 10
#: A last word that so many other texts have as their last after the same words, and so often among all that goes on
#: after those words, is whole, even if it occurs nowhere else. Words with digits count alike whatever the digits.
USUAL_END, USUAL_SHARE = 1, 0.2


def word_hash(word: str) -> int:
    return xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))


def normal(word: str) -> str:
    """Lower case, every digit a 9."""
    return DIGIT.sub("9", word.lower())


def classify(token: str) -> tuple[str | None, int]:
    """The normal word of a token, or None, and its kind."""
    if token == "\n":
        return None, BREAK
    if token == "":
        return None, END
    # Words of ASCII, and of letters only with ASCII marks after them, need no patterns.
    head = token.rstrip(ASCII_MARKS)
    if head and token.isascii():
        return head.lstrip(ASCII_MARKS).lower().translate(NINES), _kind(token[len(head) :])
    if head.isalpha() and TATWEEL not in head:
        return head.lower(), _kind(token[len(head) :])
    token = INVISIBLE.sub("", token).replace(BROKEN, "")
    m = CORE.search(token)
    after = token[m.end() :] if m else token
    if m is None:
        if "…" in after or ".." in after:
            return None, GAP
        if any(c in CLOSERS for c in token):
            return None, MARK
        return None, JOINT if token and all(c in HANGING or c in PAUSES or c in COLON or c in "\"'«»" for c in token) and token != "/" or not token else BREAK
    return normal(m.group()), _kind(after)


def _kind(after: str) -> int:
    """The kind of a word by what follows it in its token."""
    if not after:
        return PLAIN
    if "…" in after or ".." in after:
        return ELLIPSIS
    if any(c in CLOSERS or c in PAUSES for c in after):
        return CLOSED
    return COMMA if any(c in HANGING for c in after) else PLAIN


class _Words(dict):
    """Token -> its number in the columns ``hashes`` and ``kinds``."""

    def __init__(self):
        super().__init__()
        self.hashes, self.kinds, self.words = [], [], []

    def __missing__(self, token: str) -> int:
        word, kind = classify(token)
        n = self[token] = len(self.hashes)
        self.hashes.append(word_hash(word) if word is not None else 0)
        self.kinds.append(kind)
        self.words.append(word)
        return n


def tokens_of(text: str) -> list[str]:
    out: list[str] = []
    for line in text.splitlines():
        out += line.split()
        out.append("\n")
    out.append("")
    return out


def scan(texts: list[str | None], known: _Words) -> dict[str, np.ndarray]:
    """All tokens of the texts as vectors, joints left out: number, hash, kind, text, whether a sentence ended (+1), went on
    (-1) or nothing is known (0) after a word, and the start of its sentence."""
    numbers: list[int] = []
    sizes = np.zeros(len(texts), np.int64)
    for i, t in enumerate(texts):
        part = list(map(known.__getitem__, tokens_of(t or "")))
        numbers += part
        sizes[i] = len(part)
    num = np.array(numbers, np.int64)
    text = np.repeat(np.arange(len(texts)), sizes)
    kind = np.array(known.kinds, np.int8)[num]
    keep = kind != JOINT
    joint_next = np.zeros(len(num), bool)
    joint_next[:-1] = ~keep[1:]
    num, text, kind, joint_next = num[keep], text[keep], kind[keep], joint_next[keep]
    word = kind >= PLAIN
    following = np.full(len(kind), END, np.int8)
    following[:-1] = kind[1:]
    went = np.zeros(len(kind), np.int8)
    went[word & (following >= PLAIN)] = -1
    went[word & ((following == BREAK) | (following == MARK)) & ~joint_next] = 1
    went[kind == CLOSED] = 1
    went[(kind == COMMA) & (following >= PLAIN)] = -1
    went[kind == ELLIPSIS] = 0
    # The break that splitting adds after the last line tells nothing.
    last = np.zeros(len(kind), bool)
    last[:-1] = following[:-1] == BREAK
    after = np.full(len(kind), END, np.int8)
    after[:-2] = kind[2:]
    went[last & (after == END) & (kind != CLOSED)] = 0
    fresh = np.ones(len(kind), bool)
    fresh[1:] = (went[:-1] == 1) | ~word[:-1] | (text[1:] != text[:-1])
    start = np.maximum.accumulate(np.where(fresh, np.arange(len(kind)), 0)) if len(kind) else num
    return {"num": num, "hash": np.array(known.hashes, np.uint64)[num] if len(num) else num.astype(np.uint64), "kind": kind, "text": text, "went": went, "start": start}


def ending(text: str | None, known: _Words, least: int = 160) -> str | None:
    """As much of a text's end as decides what :func:`tails` asks of it: from a blank on, with more words than any context
    and its start can take. Doubled until that holds, to the whole text if need be; the result is that of the whole text."""
    size = least
    while text and size < len(text):
        part = text[-size:]
        first = next((i for i, c in enumerate(part) if c.isspace()), None)
        if first is not None:
            part = part[first:]
            if sum(known.kinds[known[t]] >= PLAIN for t in part.split()) > max(ORDERS) + 3:
                return part
        size *= 2
    return text


def context_keys(s: dict[str, np.ndarray], at: np.ndarray, order: int, salt: str | None = None) -> np.ndarray:
    """One key for the ``order`` words up to each position; places before the sentence count as its start."""
    key = np.full(len(at), SALTS[salt or order], np.uint64)
    for back in range(order):
        i = at - back
        inside = i >= s["start"][at]
        h = np.where(inside, s["hash"][np.where(inside, i, 0)], START)
        key = (key ^ h) * np.uint64(0x100000001B3)
        key ^= key >> np.uint64(29)
    return key


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def prefix_keys(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """A key for every prefix of every word, the word itself last, and the lengths of the words; in time that grows with their
    length: the hash of a prefix is a polynomial of its characters, summed up along the word."""
    sizes = np.array([len(w) for w in words], np.int64)
    codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    if not len(codes):
        return codes, sizes
    starts = np.repeat(np.cumsum(sizes) - sizes, sizes)
    place = np.arange(len(codes)) - starts
    powers = np.cumprod(np.full(int(sizes.max()), 0x9FB21C651E98DF25, np.uint64))
    sums = np.cumsum(_mixed(codes + np.uint64(1)) * powers[place])
    own = sums - np.concatenate([np.zeros(1, np.uint64), sums])[starts]
    return _mixed(own ^ (place + 1).astype(np.uint64)), sizes


def _signed(a: np.ndarray) -> np.ndarray:
    return a.astype(np.uint64).view(np.int64)


TAIL = T.StructType(
    [T.StructField("row", T.LongType()), T.StructField("n_chars_", T.LongType()), T.StructField("n_bytes", T.LongType()), T.StructField("text_hash", T.LongType())]
    + [T.StructField("closed", T.BooleanType()), T.StructField("broken", T.BooleanType()), T.StructField("dangling", T.BooleanType()), T.StructField("ellipsis", T.BooleanType())]
    + [T.StructField(f"c{k}", T.LongType()) for k in ORDERS]
    + [T.StructField("before5", T.LongType()), T.StructField("before2", T.LongType()), T.StructField("next5", T.LongType()), T.StructField("prefix", T.LongType()), T.StructField("number", T.BooleanType())]
)
UNITS = ["n_chars_", "n_bytes"]
KEYS = [*(f"c{k}" for k in ORDERS), "before5", "before2", "next5", "prefix"]


def tails(df: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """One row for each text with a word, or without one but broken at the end: the kept columns and what its end looks like."""
    prepare(df)
    source = df.select(F.col(text).cast("string").alias("_text_"), *keep)
    out = T.StructType([*source.schema.fields[1:], *TAIL.fields[1:]])

    def run(batches):
        known = _Words()
        for b in batches:
            if len(known) > MOST_REMEMBERED:
                known = _Words()
            texts = b.column(0).to_pylist()
            s = scan([ending(t, known) for t in texts], known)
            words = np.flatnonzero(s["kind"] >= PLAIN)
            of = s["text"][words]
            ends = np.ones(len(words), bool)
            ends[:-1] = of[1:] != of[:-1]
            at = words[ends]
            rows = s["text"][at]
            closed, broken, dangling, ellipsis = [], [], [], []
            for i, r in zip(at.tolist(), rows.tolist()):
                t = texts[r].rstrip()
                tail = t[-12:]
                kind = s["kind"][i]
                rest = s["kind"][i + 1 :][: len(t)]
                stop = int(np.argmax(rest == END)) if len(rest) else 0
                rest = rest[:stop]
                closed.append(bool(kind == CLOSED or (kind != ELLIPSIS and (rest == MARK).any())))
                broken.append(t.endswith(BROKEN))
                plain = INVISIBLE.sub("", tail).rstrip()
                dangling.append(bool(plain) and plain[-1] in HANGING)
                ellipsis.append(bool(kind == ELLIPSIS or (rest == GAP).any()))
            columns = [pa.array([len(texts[r]) for r in rows], pa.int64()), pa.array([len(texts[r].encode("utf-8", "surrogatepass")) for r in rows], pa.int64())]
            columns.append(pa.array(_signed(np.array([word_hash(texts[r][: LAST_OF_WORD.search(texts[r]).end()]) for r in rows], np.uint64)), pa.int64()))
            columns += [pa.array(x, pa.bool_()) for x in (closed, broken, dangling, ellipsis)]
            columns += [pa.array(_signed(context_keys(s, at, k)), pa.int64()) for k in ORDERS]
            has_before = at > s["start"][at]
            columns += [pa.array(_signed(context_keys(s, np.maximum(at - 1, 0), k)), pa.int64(), mask=~has_before) for k in (5, 2)]
            columns.append(pa.array(_signed(context_keys(s, np.maximum(at - 1, 0), 5, "next")), pa.int64(), mask=~has_before))
            last_words = [known.words[n] for n in s["num"][at].tolist()]
            whole, sizes = prefix_keys(last_words)
            columns.append(pa.array(_signed(whole[np.cumsum(sizes) - 1]), pa.int64()))
            columns.append(pa.array(["9" in w for w in last_words], pa.bool_()))
            kept = b.take(pa.array(rows)).columns[1:] if len(rows) else [pa.array([], c.type) for c in b.columns[1:]]
            yield pa.RecordBatch.from_arrays([*kept, *columns], names=out.names)
            wordless = np.setdiff1d(np.arange(len(texts)), rows)
            lost = [r for r in wordless.tolist() if texts[r] and texts[r].rstrip().endswith(BROKEN)]
            if lost:
                yield wordless_tails(b.take(pa.array(lost)), out)

    return source.mapInArrow(run, out)


def wordless_tails(b: pa.RecordBatch, out: T.StructType) -> pa.RecordBatch:
    """The rows of :func:`tails` for texts without a word that end with a broken character; they have no contexts."""
    texts = b.column(0).to_pylist()
    sizes = [pa.array([len(t) for t in texts], pa.int64()), pa.array([len(t.encode("utf-8", "surrogatepass")) for t in texts], pa.int64())]
    text_hash = pa.array(_signed(np.array([word_hash(t) for t in texts], np.uint64)), pa.int64())
    flags = {"broken": True, "closed": False, "dangling": False, "ellipsis": False, "number": False}
    rest = [pa.array([flags[f.name]] * len(texts), pa.bool_()) if f.name in flags else pa.nulls(len(texts), pa.int64()) for f in TAIL.fields[4:]]
    return pa.RecordBatch.from_arrays([*b.columns[1:], *sizes, text_hash, *rest], names=out.names)


@dataclass(frozen=True)
class Wanted:
    """A bit for each key that is asked for, of those that belong to one of ``arrays`` arrays."""

    words: np.ndarray
    array: int
    arrays: int

    def asked(self, keys: np.ndarray) -> np.ndarray:
        place = keys & np.uint64(len(self.words) * 64 - 1)
        held = (self.words[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1
        return held & ((keys >> np.uint64(40)) % np.uint64(self.arrays) == self.array) if self.arrays > 1 else held


def arrays_for(keys: int) -> tuple[int, int]:
    """The size of a bit array and the number of arrays for so many keys; at most MOST_BITS / 8 bytes are broadcast at once."""
    arrays = min(MOST_ARRAYS, max(1, -(-keys * BITS_A_KEY // (2 * MOST_BITS))))
    return min(MOST_BITS, max(LEAST_BITS, 1 << (BITS_A_KEY * max(1, keys) // arrays - 1).bit_length())), arrays


def wanted_bits(keys: DataFrame, bits: int, array: int = 0, arrays: int = 1) -> Wanted:
    """The bit array of the keys (a column ``key``) that belong to it; at most ``bits / 64`` words come to the driver."""
    own = keys.filter(F.expr(f"pmod(shiftrightunsigned(key, 40), {arrays}L) = {array}")) if arrays > 1 else keys
    rows = bit_words(own, "key", bits).toArrow()
    words = np.zeros(bits // 64, np.uint64)
    words[rows.column("w").to_numpy()] = rows.column("b").to_numpy().view(np.uint64)
    return Wanted(words, array, arrays)


def corpus_counts(df: DataFrame, wanted, text: str = "text") -> DataFrame:
    """(key, ended, went_on) over all positions of all texts but their ends, for the keys asked for (``wanted``: a broadcast of
    :class:`Wanted`), summed in each task; the same key may come from several tasks."""
    source = df.select(F.col(text).cast("string").alias("_text_"))

    def run(batches):
        asked = wanted.value.asked
        known = _Words()
        counts = np.zeros(0, np.int64)
        keys, ended, went_on, held = [], [], [], 0

        def add(k: np.ndarray, e: np.ndarray, m: np.ndarray) -> None:
            nonlocal held
            if len(k):
                u, inverse = np.unique(k, return_inverse=True)
                keys.append(u)
                ended.append(np.bincount(inverse, e, len(u)))
                went_on.append(np.bincount(inverse, m, len(u)))
                held += len(u)

        def flush():
            nonlocal held
            u, inverse = np.unique(np.concatenate(keys), return_inverse=True)
            e, m = (np.bincount(inverse, np.concatenate(x), len(u)).astype(np.int64) for x in (ended, went_on))
            for x in (keys, ended, went_on):
                x.clear()
            keys.append(u), ended.append(e), went_on.append(m)
            held = len(u)
            return pa.RecordBatch.from_arrays([pa.array(_signed(u)), pa.array(e), pa.array(m)], names=["key", "ended", "went_on"])

        def add_prefixes() -> None:
            """The words seen so far, each with its occurrences, to the nodes above them that are asked for."""
            nonlocal counts
            seen = np.flatnonzero(counts)
            for part in np.array_split(seen, 1 + sum(len(known.words[n]) for n in seen.tolist()) // FLUSH):
                nodes, sizes = prefix_keys([known.words[n] for n in part.tolist()])
                proper = np.ones(len(nodes), bool)
                proper[np.cumsum(sizes) - 1] = False
                c, ok = np.repeat(counts[part], sizes).astype(float), proper & asked(nodes)
                add(nodes[ok], np.zeros(int(ok.sum())), c[ok])
            counts = np.zeros(0, np.int64)

        for b in batches:
            if len(known) > MOST_REMEMBERED:
                add_prefixes()
                known = _Words()
            s = scan(b.column(0).to_pylist(), known)
            at = np.flatnonzero(s["went"] != 0)
            e, m = (s["went"][at] == 1).astype(float), (s["went"][at] == -1).astype(float)
            for order in (1, 2):
                k = context_keys(s, at, order)
                ok = asked(k)
                add(k[ok], e[ok], m[ok])
            # Who asks for a longer context asks for its last two words as well; who asks for what may follow, for what is before.
            if wanted.value.arrays > 1:
                ok = np.ones(len(at), bool)
            at, e, m = at[ok], e[ok], m[ok]
            for order in (3, 5):
                k = context_keys(s, at, order)
                ok = asked(k)
                add(k[ok], e[ok], m[ok])
            before = np.zeros(len(s["kind"]) + 1, bool)
            before[at[ok] if wanted.value.arrays == 1 else at] = True
            every = np.flatnonzero(s["went"] != 0)
            inner = every[(every > s["start"][every]) & before[every - 1]]
            k = context_keys(s, inner - 1, 5, "next")
            ok = asked(k)
            add(k[ok], (s["went"][inner] == 1).astype(float)[ok], (s["went"][inner] == -1).astype(float)[ok])
            counts = np.concatenate([counts, np.zeros(len(known.hashes) - len(counts), np.int64)])
            counts += np.bincount(s["num"][s["went"] != 0], minlength=len(counts))
            if held > FLUSH:
                out = flush()
                if held > FLUSH // 2:  # many different keys: pass them on
                    keys.clear(), ended.clear(), went_on.clear()
                    held = 0
                    yield out
        add_prefixes()
        if keys:
            yield flush()

    return source.mapInArrow(run, "key bigint, ended bigint, went_on bigint")


def piled_lengths(open_tails: DataFrame) -> DataFrame:
    """_source, _unit (n_chars_ or n_bytes), _length: where many more different unclosed texts of a source end than around."""
    lengths = F.inline(F.array(*[F.struct(F.lit(u).alias("unit"), F.col(u).alias("length")) for u in UNITS]))
    n = open_tails.select("source", "text_hash", lengths).distinct().groupBy("source", "unit", "length").agg(F.count("*").alias("n"))
    # One row for each source and length.
    around = Window.partitionBy("source", "unit").orderBy("length").rangeBetween(-NEIGHBOURS, NEIGHBOURS)
    mean = (F.sum("n").over(around) - F.col("n")) / (2 * NEIGHBOURS)
    piled = (F.col("n") >= PILE) & (F.col("n") >= F.col("mean") + PILE_DEVIATIONS * F.sqrt(F.col("mean") + 1))
    return n.withColumn("mean", mean).filter(piled).select(F.col("source").alias("_source"), F.col("unit").alias("_unit"), F.col("length").alias("_length"))


def with_piles(rows: DataFrame, open_tails: DataFrame) -> DataFrame:
    """Adds ``piled``: whether a text's length, in characters or bytes, is one at which its source's unclosed texts pile up."""
    piles, held = small_or_stored(piled_lengths(open_tails), "piles")
    rows = rows.withColumn("piled", F.lit(False))
    for unit in UNITS:
        mine = piles.filter(F.col("_unit") == unit)
        mine = F.broadcast(mine) if held is not None else mine  # at most MOST_LOCAL_ROWS rows
        same = F.col("source").eqNullSafe(F.col("_source")) & (F.col(unit) == F.col("_length"))
        rows = rows.join(mine, same, "left").withColumn("piled", F.col("piled") | F.col("_length").isNotNull()).drop("_source", "_unit", "_length")
    return rows


def judged(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """doc_id, source, ``truncated`` and ``evidence`` for every text that has a word or is broken at the end."""
    columns = df.select(F.col(key).alias("doc_id"), F.col(source).alias("source"), F.col(text).alias("text"))
    spark = df.sparkSession
    every = persist_table(tails(columns, ["doc_id", "source"]), "tails")
    total = every.count()  # reads footers only
    unclosed = every.filter(~F.col("closed") | F.col("broken"))
    shape = F.xxhash64(*[x for k in KEYS for x in (F.col(k).isNull(), F.col(k))]).alias("shape")
    shapes = persist_table(unclosed.groupBy(*KEYS).agg(F.count("*").alias("n")).select(shape, "n", *KEYS), "shapes")
    n_shapes = shapes.count()
    asks = shapes.select("shape", "n", F.posexplode(F.array(*KEYS)).alias("slot", "key")).filter(F.col("key").isNotNull())
    bits, arrays = arrays_for(n_shapes * len(KEYS))
    counts = [corpus_counts(columns, spark.sparkContext.broadcast(wanted_bits(asks.select("key"), bits, i, arrays))) for i in range(arrays)]
    # Other texts with the same unclosed end are evidence of an end. They count as often as they occur, as all of the corpus
    # does, but for the copies of the text in question. c5 and before5 are keys of one kind, yet counted apart: a text that
    # goes on by one more word is no evidence that the words before it are an end.
    n, slot, none = F.col("n"), F.col("slot"), F.lit(0).cast("bigint")
    asked = asks.select("key", F.lit(1).cast("bigint").alias("asked"), F.when(slot < len(ORDERS), n).otherwise(none).alias("at_end"), F.when(slot == len(ORDERS), n).otherwise(none).alias("before_end"), none.alias("ended"), none.alias("went_on"))
    counted = [c.select("key", none.alias("asked"), none.alias("at_end"), none.alias("before_end"), "ended", "went_on") for c in counts]
    sums = reduce(DataFrame.unionByName, [asked, *counted]).groupBy("key").agg(*[F.sum(c).alias(c) for c in ("asked", "at_end", "before_end", "ended", "went_on")]).filter(F.col("asked") > 0)
    if total >= LEAST_ROWS:
        sums = persist_table(sums, "sums")
    told = join_facts(asks, sums, ["key"], "asked", n_shapes * len(KEYS))
    told = told.withColumn("finals", F.when(slot < len(ORDERS), F.col("at_end")).otherwise(F.col("before_end")))
    facts = told.groupBy("shape").agg(F.first("n").alias("n"), *[F.expr(f"coalesce(max({c}) FILTER (WHERE slot = {i}), 0L) AS {k}_{c}") for i, k in enumerate(KEYS) for c in ("ended", "went_on", "finals")])
    texts = unclosed.groupBy("text_hash", shape).agg(F.count("*").alias("copies"), F.first("before5").isNull().alias("starts"))
    if total >= LEAST_ROWS:
        facts, texts = persist_table(facts, "facts"), persist_table(texts, "texts")
    known = join_facts(texts, facts, ["shape"], "n", total).drop("shape", "n")
    if total >= LEAST_ROWS:
        known = persist_table(known, "known")
    rows = with_piles(unclosed.filter(~F.col("broken")), unclosed).select("doc_id", "source", "text_hash", "number", "ellipsis", "dangling", "piled")
    rows = join_facts(rows, known, ["text_hash"], "copies", total)
    found = rows.select("doc_id", "source", evidence().alias("evidence"))
    told_apart = F.when(F.col("broken"), "broken character").alias("evidence")
    return found.unionByName(every.filter(F.col("closed") | F.col("broken")).select("doc_id", "source", told_apart)).withColumn("truncated", F.col("evidence").isNotNull())


def evidence() -> Column:
    """Why a text that is not broken at the end is cut, or null."""
    c = F.col
    piled = c("piled")
    hint = piled | c("ellipsis") | c("dangling")
    others, near = (F.greatest(c(x) - c("copies"), F.lit(0)) for x in ("c5_finals", "before5_finals"))
    # What else could stand there: all that goes on after the words before, or, at the start of a sentence, the longer words.
    rivals = F.when(c("starts"), c("prefix_went_on")).otherwise(c("before5_went_on"))
    usual = F.when(c("number"), (near >= USUAL_END) & (near >= USUAL_SHARE * c("before5_went_on"))).otherwise((others >= USUAL_END) & (others >= USUAL_SHARE * rivals))
    ends = {k: c(f"c{k}_ended") + F.when(usual, others).otherwise(F.lit(0)) for k in ORDERS}
    support = {k: ends[k] + c(f"c{k}_went_on") for k in ORDERS}
    share = {k: F.try_divide(ends[k].cast("double"), support[k]) for k in ORDERS}
    unknown = (c("c1_ended") + c("c1_went_on")) == 0
    prefix = (c("prefix_went_on") >= 2) & ~usual
    limit = F.when(hint, DOUBTFUL_END).otherwise(RARE_END)
    # How often a sentence ends with the word after the words before, whatever that word is.
    next_support = c("next5_ended") + c("next5_went_on") + near
    next_share = F.try_divide((c("next5_ended") + near).cast("double"), next_support)
    unseen = support[5] < SUPPORT
    novel = (c("c5_ended") + c("c5_went_on")) == 0
    # Without a hint a single occurrence of these words says more than many of fewer words.
    placed = next_support >= F.when(hint, SUPPORT).otherwise(1)
    seen = F.when(~unseen, share[5]).when(placed, next_share).when(support[3] >= SUPPORT, share[3]).when(support[2] >= SUPPORT, share[2])
    two_only = unseen & ~placed & (support[3] < SUPPORT)
    limit = F.when(hint & two_only, DOUBTFUL_END_OF_TWO).otherwise(limit)
    after_known = (c("before5_went_on") >= SUPPORT) | ((c("before2_went_on") >= SUPPORT) & ~c("number"))
    return (
        F.when(unknown & prefix & ~c("number"), "word")
        .when(piled & c("dangling"), "sentence and length")
        .when(novel & prefix & ~c("number") & (c("before5_went_on") >= SUPPORT), "word in context")
        .when(hint & unseen & c("number") & prefix & after_known, "word in context")
        .when(seen.isNotNull(), F.when(seen <= limit, F.when(hint, "sentence and length").otherwise("sentence")))
        .when(prefix & after_known, "word in context")
        .when(hint & ~usual, "length")
        .when((support[1] >= 20) & (share[1] <= RARE_END), "sentence")
    )


def source_report(found: DataFrame) -> DataFrame:
    """By source: texts that have a word or are broken at the end, cut ones, and their share."""
    return found.groupBy("source").agg(F.count("*").alias("n_texts"), F.count_if("truncated").alias("n_truncated"), (F.count_if("truncated") / F.count("*")).alias("share"))
