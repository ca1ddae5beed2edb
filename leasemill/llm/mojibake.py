"""Problem 2: text that was read in a wrong encoding: where it stands, and what it was.

A corpus gives the mutual information of adjacent characters: how much oftener two characters stand side by side than
their own frequencies say. A pair weighs more the less it is to be expected; pairs that the corpus never has weigh most,
expected ones weigh below zero. In a text the maximal-scoring segments over these weights (all of them, in linear time)
are the improbable runs, widened to the blanks around. Only inside such runs inverse mappings are tried: the characters
back to bytes by each encoding that may have been read wrongly, the bytes to text by each that may have been meant, over and
over as long as the bytes are strict UTF-8, which makes the text shorter each time. A mapping is believed if its result is much more probable than what stood there; a run that maps back
in part only, or holds marks of lost characters, is garbled beyond recovery.

The character pairs are those of a fixed alphabet (``SYMBOLS``): common blocks one by one, the rest by block. So the table
that goes to the workers has a bounded size, one byte for each of SYMBOLS**2 pairs and sixteen for those that occur, whatever
the corpus.

Defined results: null, empty and blank texts are not garbled; a text is judged as it stands, blanks included; repeated
rows are judged alike; an empty corpus knows no pair, so nothing can be believed restored and only lost characters and
strict UTF-8 are found; texts of any length are read whole. ``restored`` is null unless every garbled run was recovered.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leasemill.llm.encode import own_name, prepare

#: Encodings whose reading of foreign bytes is tried, and the single-byte ones that may have been meant besides UTF-8.
READ_AS = ["cp1252", "latin-1", "cp1256", "mac_roman", "cp437", "cp850", "iso8859-6", "cp720", "cp1251", "cp1254", "cp1250", "iso8859-15", "koi8-r", "cp866"]
MEANT = ["cp1256", "iso8859-6", "mac_arabic", "cp720"]

#: The weight of a pair is -(shrunken mutual information) - MARGIN, in bits.
MARGIN, FLOOR, SHRINK = 1.0, -4.0, 2.0
#: A segment below this score is no run; a mapping must bring a run's score down to this share, to UTF-8 or otherwise.
LEAST_SCORE, BELIEVED, UTF8_BELIEVED = 2.0, 0.6, 0.75
#: Strict UTF-8 of letters and signs that names are written with is also believed if it is so many bits more common.
UTF8_GAIN = 10.0
#: One single-byte encoding for another is also believed if the text is so many bits a character more common.
BYTE_GAIN = 5.0
#: Weights are held in eighths of a bit.
SCALE = 8

COMMON, SIGNS = 0x700, (0x2000, 0x2700)
_BLOCK0 = COMMON + SIGNS[1] - SIGNS[0]
#: Blocks of 256 up to U+FFFF, the sixteen planes beyond, and the replacement character.
SYMBOLS = _BLOCK0 + 256 + 16 + 1
LOST = "�"


@lru_cache(maxsize=1)
def symbol_table() -> np.ndarray:
    """Code point -> symbol: digits are one, white space is one, common blocks stand for themselves, others for their block."""
    code = np.arange(0x110000)
    out = (_BLOCK0 + np.where(code < 0x10000, code // 256, 255 + code // 0x10000)).astype(np.uint16)
    out[:COMMON] = code[:COMMON]
    out[SIGNS[0] : SIGNS[1]] = COMMON + np.arange(SIGNS[1] - SIGNS[0])
    for c in [*range(0x30, 0x3A), *range(0x660, 0x66A), *range(0x6F0, 0x6FA)]:
        out[c] = 0x30
    for c in (0x09, 0x0A, 0x0D, 0x2028, 0x2029):
        out[c] = 0x20
    out[0xFFFD] = SYMBOLS - 1
    return out


def symbols(text: str) -> np.ndarray:
    return symbol_table()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]


def pair_counts(corpus: DataFrame, text: str) -> DataFrame:
    """(a, b, n): how often symbol b follows symbol a, over all texts, blanks at the ends included. Combined in each batch."""
    prepare(corpus)
    source = corpus.select(F.col(text).cast("string").alias("_text_"))

    def run(batches):
        for batch in batches:
            joined = " " + " ".join(t for t in batch.column(0).to_pylist() if t) + " "
            s = symbols(joined).astype(np.int64)
            codes, n = np.unique(s[:-1] * SYMBOLS + s[1:], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(codes // SYMBOLS), pa.array(codes % SYMBOLS), pa.array(n.astype(np.int64))], names=["a", "b", "n"])

    return source.mapInArrow(run, "a bigint, b bigint, n bigint").groupBy("a", "b").agg(F.sum("n").alias("n"))


def pair_weights(a: np.ndarray, b: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The weights of all pairs of symbols, SYMBOLS x SYMBOLS bytes."""
    total = max(1.0, float(n.sum()))
    first = np.bincount(a, n, SYMBOLS)
    second = np.bincount(b, n, SYMBOLS)
    unseen = -(FLOOR - np.log2(1.0 + np.outer(first, second / total).astype(np.float32))) - MARGIN
    out = np.clip(np.rint(unseen * SCALE), -127, 127).astype(np.int8)
    if len(n):
        pmi = np.log2(n * total / (first[a] * second[b]))
        shrunk = (n * pmi + SHRINK * FLOOR) / (n + SHRINK)
        out[a, b] = np.clip(np.rint((-shrunk - MARGIN) * SCALE), -127, 127)
    # Marks of lost characters are never to be expected, even if the corpus has lost some: a replacement character beside
    # anything, and a question mark before another one or before a letter.
    never = int((-FLOOR - MARGIN) * SCALE)
    out[SYMBOLS - 1, :] = out[:, SYMBOLS - 1] = never
    letters = np.array([c for c in range(COMMON) if c == 0x3F or chr(c).isalpha()])
    out[0x3F, letters] = np.maximum(out[0x3F, letters], never)
    return out


@dataclass(frozen=True)
class PairTable:
    """What the workers know of the corpus: the weights of all pairs, and how common the pairs are that occur."""

    weights: np.ndarray
    keys: np.ndarray
    logs: np.ndarray
    unseen: float


def pair_table(a: np.ndarray, b: np.ndarray, n: np.ndarray) -> PairTable:
    order = np.argsort(a * SYMBOLS + b)
    total = max(1.0, float(n.sum()))
    return PairTable(pair_weights(a, b, n), (a * SYMBOLS + b)[order], np.log2(n[order] / total), float(np.log2(0.25 / total)))


def corpus_pairs(corpus: DataFrame, text: str) -> PairTable:
    """The pair table of a corpus; at most SYMBOLS**2 counts come to the driver, in practice some thousands."""
    t = pair_counts(corpus, text).toArrow()
    return pair_table(*(t.column(c).to_numpy() for c in ("a", "b", "n")))


def maximal_segments(weights: list[float]) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (start, end, score), disjoint and in order, in linear time."""
    stack: list[tuple[int, int, float, float]] = []  # start, end, sum before, sum at the end
    total = 0.0
    for i, w in enumerate(weights):
        before, total = total, total + w
        if w <= 0:
            continue
        start, low, high = i, before, total
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= low:
                j -= 1
            if j < 0 or stack[j][3] >= high:
                stack.append((start, i + 1, low, high))
                break
            start, low = stack[j][0], stack[j][2]
            del stack[j:]
    return [(a, b, r - l) for a, b, l, r in stack]


def to_bytes(text: str, encoding: str) -> bytes | None:
    """The bytes that the encoding reads as the text; bytes it leaves undefined are read as the control characters."""
    try:
        return text.encode(encoding)
    except UnicodeEncodeError:
        out = bytearray()
        for c in text:
            try:
                out += c.encode(encoding)
            except UnicodeEncodeError:
                if not 0x80 <= ord(c) <= 0x9F:
                    return None
                out.append(ord(c))
        return bytes(out)


def is_arabic(c: str) -> bool:
    return "ء" <= c <= "ۓ"


def is_usual(c: str) -> bool:
    """ASCII, letters of Latin-1 and Latin Extended-A, Arabic, and general punctuation or number signs."""
    return "\x20" <= c <= "\x7e" or "\xa0" <= c <= "\u017f" or "\u0600" <= c <= "\u06ff" or "\u2010" <= c <= "\u2030" or c in "\u200e\u200f№"


class Judge:
    """Judges texts by the weight table; what it has decided about a run it remembers."""

    def __init__(self, table: PairTable):
        self.table, self.weights = table, table.weights
        self.known: dict[str, tuple[str, str | None] | None] = {}
        self.mappings: dict[str, tuple[float, str, str] | None] = {}

    def pairs(self, text: str) -> np.ndarray:
        s = symbols(f" {text} ")
        return self.weights[s[:-1], s[1:]]

    def badness(self, text: str) -> float:
        w = self.pairs(text)
        return float(w[w > 0].sum()) / SCALE

    def commonness(self, text: str) -> float:
        """How common the pairs of a text are in the corpus; to choose between readings that are probable alike."""
        s = symbols(f" {text} ").astype(np.int64)
        keys = s[:-1] * SYMBOLS + s[1:]
        at = np.minimum(np.searchsorted(self.table.keys, keys), max(0, len(self.table.keys) - 1))
        if not len(self.table.keys):
            return 0.0
        return float(np.where(self.table.keys[at] == keys, self.table.logs[at], self.table.unseen).sum())

    def runs(self, text: str) -> list[tuple[int, int]]:
        """The improbable runs, widened to the blanks around and joined where they meet."""
        w = self.pairs(text)
        if not (w > 0).any():
            return []
        out: list[tuple[int, int]] = []
        for start, end, score in maximal_segments((w / SCALE).tolist()):
            if score < LEAST_SCORE:
                continue
            # Pair i lies between the characters i - 1 and i of the text.
            a, b = max(0, start - 1), min(len(text), end)
            a = text.rfind(" ", 0, a) + 1 if text[a : a + 1] != " " else a + 1
            b = text.find(" ", b - 1) if b and text[b - 1 : b] != " " else b - 1
            b = len(text) if b < 0 else b
            if a >= b:
                continue
            if out and a <= out[-1][1]:
                out[-1] = (out[-1][0], max(b, out[-1][1]))
            else:
                out.append((a, b))
        return out

    def mapped(self, run: str, before: float) -> tuple[float, str, str] | None:
        """The best believed inverse mapping of a run: how common its text is, mapping, text. Each text is looked into once,
        and a text garbled n times is some 2^n times as long as it was, so the work grows with the run."""
        if run not in self.mappings:
            self.mappings[run] = self._best_mapping(run, before)
        return self.mappings[run]

    def _best_mapping(self, run: str, before: float) -> tuple[float, str, str] | None:
        """As :meth:`mapped` says.

        Strict UTF-8 is strong evidence in itself. One single-byte encoding for another is believed only of runs that hold
        a letter which is not Arabic: from Arabic to Arabic the pairs alone say too little.
        """
        best, stood = None, self.commonness(run)
        foreign = any(c.isalpha() and not is_arabic(c) for c in run)
        for wrong in READ_AS:
            raw = to_bytes(run, wrong)
            if raw is None:
                continue
            for right in ("utf-8", *MEANT):
                if right == wrong or (right != "utf-8" and not foreign):
                    continue
                try:
                    text = raw.decode(right)
                except UnicodeDecodeError:
                    continue
                if text == run or (right == "utf-8" and len(text) == len(run)) or any("\x80" <= c <= "\x9f" for c in text) and right != "utf-8":
                    continue
                after, common = self.badness(text), self.commonness(text)
                name = f"{right} read as {wrong}"
                if right == "utf-8":
                    good = after <= UTF8_BELIEVED * before or (common >= stood + UTF8_GAIN and all(map(is_usual, text)))
                else:
                    letters = [c for c in text if c.isalpha()]
                    arabic = sum(map(is_arabic, letters))
                    good = arabic >= 2 and arabic >= 0.8 * len(letters) and common > stood and (after <= BELIEVED * before or common >= stood + BYTE_GAIN * len(run))
                if good and (best is None or (all(map(is_usual, text)), common) > (all(map(is_usual, best[2])), best[0])):
                    best = (common, name, text)
                if right == "utf-8" and after > 0.5 and len(text) < len(run):
                    deeper = self.mapped(text, after)
                    if deeper and (best is None or deeper[0] > best[0]):
                        best = (deeper[0], f"{name}, {deeper[1]}", deeper[2])
        return best

    def partly(self, run: str) -> str | None:
        """The mapping by which most of a run is UTF-8 of a probable text, with bytes missing or replaced."""
        for wrong in READ_AS:
            raw = to_bytes(run.replace(LOST, ""), wrong)
            if raw is None:
                continue
            text = raw.decode("utf-8", "replace")
            lost = text.count(LOST)
            found = [c for c in text if ord(c) > 0x7F and c != LOST]
            if found and 0 < lost <= len(found) and sum(map(is_arabic, found)) >= 0.7 * len(found):
                return f"utf-8 read as {wrong}"
        return None

    def decide(self, run: str) -> tuple[str, str | None] | None:
        """(mapping, original or None) of a garbled run; None if it is no garbled one."""
        if run in self.known:
            return self.known[run]
        if len(self.known) > 200_000:
            self.known.clear()
            self.mappings.clear()
        out: tuple[str, str | None] | None = None
        if LOST in run:
            out = (self.partly(run) or "lost", None)
        elif any(ord(c) > 0x7F for c in run):
            best = self.mapped(run, self.badness(run))
            if best:
                out = (best[1], best[2])
            elif part := self.partly(run):
                out = (part, None)
        if out is None and self.question_marks(run):
            out = ("lost", None)
        self.known[run] = out
        return out

    @staticmethod
    def question_marks(run: str) -> bool:
        """Question marks in the place of letters: several side by side before anything else, or one between letters."""
        for i, c in enumerate(run):
            if c == "?" and i + 1 < len(run):
                after = run[i + 1]
                if after == "?" and not (i and run[i - 1].isalpha() and set(run[i:]) <= {"?", "!"}):
                    return True
                if after.isalpha() and (i == 0 or run[i - 1].isalpha()):
                    return True
        return False

    def judge(self, text: str | None) -> tuple[bool, str | None, str | None]:
        """Garbled or not, the mappings of its runs, and the restored text if all of them were recovered."""
        if not text or not text.strip():
            return False, None, None
        words: list[tuple[int, str, tuple[str, str | None] | None]] = []
        for a, b in self.runs(text):
            # Words of a run are judged one by one, so that a sound word beside a garbled one stays as it is.
            i = a
            for word in text[a:b].split(" "):
                if word:
                    words.append((i, word, self.decide(word)))
                i += len(word) + 1
        believed = list(dict.fromkeys(v[0] for _, _, v in words if v))
        if not believed:
            return False, None, None
        parts, at, whole = [], 0, True
        for i, word, verdict in words:
            verdict = verdict or self.alike(word, believed)
            if verdict:
                whole = whole and verdict[1] is not None
                parts.append(text[at:i] + (verdict[1] or word))
                at = i + len(word)
        return True, "; ".join(believed), "".join(parts) + text[at:] if whole else None

    def alike(self, word: str, believed: list[str]) -> tuple[str, str] | None:
        """A word of an improbable run by a mapping that the text's other words have shown, if it makes it more probable."""
        for name in believed:
            right, _, wrong = name.partition(" read as ")
            raw = to_bytes(word, wrong) if wrong in READ_AS and right in MEANT else None
            if raw is not None:
                text = raw.decode(right, "replace")
                if LOST not in text and self.commonness(text) > self.commonness(word):
                    return name, text
        return None


def detect(df: DataFrame, key: list[str], text: str, pairs: PairTable | object) -> DataFrame:
    """The key columns, ``original``, ``garbled``, ``mapping`` and ``restored`` for every row. No shuffle.

    ``pairs`` is the table of :func:`corpus_pairs`, or a broadcast of it.
    """
    prepare(df)
    table = pairs if hasattr(pairs, "value") else df.sparkSession.sparkContext.broadcast(pairs)
    keys = [own_name(k, "original", "garbled", "mapping", "restored") for k in key]
    source = df.select(F.col(text).cast("string").alias("original"), *keys)
    out = T.StructType([*source.schema.fields, T.StructField("garbled", T.BooleanType()), T.StructField("mapping", T.StringType()), T.StructField("restored", T.StringType())])

    def run(batches):
        judge = Judge(table.value)
        for b in batches:
            texts = b.column(0).to_pylist()
            seen = {t: judge.judge(t) for t in set(texts)}
            verdicts = [seen[t] for t in texts]
            garbled, mapping, restored = zip(*verdicts) if verdicts else ((), (), ())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(garbled, pa.bool_()), pa.array(mapping, pa.string()), pa.array(restored, pa.string())], names=out.names)

    return source.mapInArrow(run, out)
