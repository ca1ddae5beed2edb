"""Problem 2: segments against brute force, and that names garbled in known ways are found and restored."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from leasemill.llm import mojibake as M

NAMES = ["بوابة روزان الكبير", "مساكن مزراح الأزرق 37", "برج ليتوم الشرقي", "ساحة حلوات الجديد", "مرتفعات سروان", "سهول دفين", "خور قنبار", "سكني - شقة", "تجاري - مكتب", "لؤلؤة وضحين الجنوبي 5"]
SOUND = ["Résidence Bélanor", "Casa Peñaluz", "Îlot Côtier", "Tower B2", "برج (×2)", "سهول دفين – مرحلة ٣", "خور قنبار ?", "‏سهول دفين", " مرتفعات  سروان ", "سهول دفین", "مرتفعاـت سروان", "Größwerk Hub", "برج ليتوم (№ 4)", "Ключи", "کرایہ نامہ", "", "   ", "?", "What?", "Who??"]
CORPUS = NAMES * 30 + ["The tenant shall pay the rent. Résidence visitée, clés reçues.", "کرایہ دار سالانہ کرایہ نامہ ادا کرے گا۔ دفین", "هل يمكنكم تأكيد موعد معاينة المطبخ؟ برج (A)", "Ключи получены, спасибо."] * 20


def brute_segments(w):
    """Maximal-scoring segments by their definition: the best segment, then the same left and right of it."""
    best = None
    for a in range(len(w)):
        s = 0.0
        for b in range(a, len(w)):
            s += w[b]
            if s > 0 and (best is None or s > best[2] + 1e-12):
                best = (a, b + 1, s)
    if best is None:
        return []
    a, b, _ = best
    shift = lambda xs, k: [(x + k, y + k, s) for x, y, s in xs]
    return brute_segments(w[:a]) + [best] + shift(brute_segments(w[b:]), b)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(-20, 20), max_size=30))
def test_segments(weights):
    w = [x + 0.37 + 0.0013 * i for i, x in enumerate(weights)]  # no ties
    got = M.maximal_segments(w)
    assert all(s > 0 for *_, s in got) and all(a[1] <= b[0] for a, b in zip(got, got[1:]))
    assert sum(s for *_, s in got) == pytest.approx(sum(s for *_, s in brute_segments(w)))
    assert {(a, b) for a, b, _ in got} == {(a, b) for a, b, _ in brute_segments(w)}


@pytest.fixture(scope="module")
def table(spark):
    corpus = spark.createDataFrame([(t, 1) for t in [*CORPUS, None, ""]], "text string, _text_ int")
    return M.corpus_pairs(corpus, "text")


@pytest.fixture(scope="module")
def judge(table):
    return M.Judge(table)


def test_counts(spark):
    got = {(r.a, r.b): r.n for r in M.pair_counts(spark.createDataFrame([("ab",), ("ab",), (None,)], "t string").coalesce(1), "t").collect()}
    assert got == {(ord(" "), ord("a")): 2, (ord("a"), ord("b")): 2, (ord("b"), ord(" ")): 2}


def test_weights_of_seen_and_unseen_pairs(table):
    w = lambda x: int(table.weights[tuple(M.symbols(x))])
    assert w("ال") < 0 < w("Ø§") and w("╪│") > 0
    assert M.symbols("5")[0] == M.symbols("٣")[0] and M.symbols("\U0001f600").max() < M.SYMBOLS


@pytest.mark.parametrize("wrong", ["cp1252", "latin-1", "cp1256", "mac_roman", "cp437"])
@pytest.mark.parametrize("depth", [1, 2, 4])
def test_utf8_read_wrongly(judge, wrong, depth):
    for name in NAMES:
        text = name
        for _ in range(depth):
            raw = text.encode()
            text = "".join(chr(b) if wrong == "cp1252" and b in (0x81, 0x8D, 0x8F, 0x90, 0x9D) else bytes([b]).decode(wrong) for b in raw)
        assert judge.judge(text)[0], text
        assert judge.judge(text)[2] == name


@pytest.mark.parametrize("right,wrong", [("cp1256", "cp1252"), ("cp1256", "latin-1"), ("iso8859-6", "cp1256")])
def test_single_byte_encodings(judge, right, wrong):
    for name in NAMES:
        text = name.encode(right).decode(wrong)
        if text != name and any(c.isalpha() and not M.is_arabic(c) for c in text):
            assert judge.judge(text)[0], text
    text = "ساحة حلوات الجديد".encode(right).decode(wrong)
    assert judge.judge(text)[2] == "ساحة حلوات الجديد"


def test_parts_and_losses(judge):
    part = "مساكن مزراح " + "الأزرق".encode().decode("mac_roman")
    assert judge.judge(part)[2] == "مساكن مزراح الأزرق"
    for lost in ("??? ????? 36", "����� �����", "سهول د?ين", "Ø³Ù‡ÙˆÙ„ Ø¯Ù�ÙŠÙ†", "سهول ����"):
        found, mapping, restored = judge.judge(lost)
        assert found and mapping and restored is None, lost


def test_losses_in_the_corpus_hide_none(spark):
    lossy = CORPUS + ["يبلغ مبلغ التأمين � دفين� ???? وين? د?ين سهو�"] * 500
    j = M.Judge(M.corpus_pairs(spark.createDataFrame([(t,) for t in lossy], "text string"), "text"))
    for lost in ("???? ????", "سهو� دفين", "سهول د?ين", "��� ����"):
        assert j.judge(lost)[0], lost
    for name in SOUND:
        assert not j.judge(name)[0], name


def test_sound_names_stay(judge):
    for name in [*SOUND, *NAMES, None]:
        assert judge.judge(name) == (False, None, None), name


def test_latin_names_are_restored(judge):
    for name in ("Villa Çelmira", "Žabrik Yard", "Ørnevik Lofts"):
        assert judge.judge(name.encode().decode("cp1252"))[2] == name


def test_frames(spark, table):
    garbled = NAMES[0].encode().decode("cp1256")
    df = spark.createDataFrame([(1, garbled, "x"), (1, garbled, "x"), (2, None, "x"), (None, NAMES[1], None), (3, "", "x"), (4, NAMES[0] * 2000, "x"), (5, garbled * 300, "x")], "key bigint, name string, weights string")
    rows = M.detect(df, ["key"], "name", table).collect()
    assert [r.garbled for r in sorted(rows, key=lambda r: r.key or 0)] == [False, True, True, False, False, False, True]
    assert {r.restored for r in rows if r.key == 1} == {NAMES[0]}
    assert M.detect(df.filter("false"), ["key"], "name", table).count() == 0
    with pytest.raises(ValueError, match="named"):
        M.detect(df.withColumnRenamed("key", "mapping"), ["mapping"], "name", table)


def test_empty_corpus(spark):
    empty = M.corpus_pairs(spark.createDataFrame([], "text string"), "text")
    j = M.Judge(empty)
    assert j.judge("���")[0] and not j.judge("سهول دفين")[0] and not j.judge("Tower")[0]


def test_table_has_a_fixed_size(table):
    assert table.weights.shape == (M.SYMBOLS, M.SYMBOLS) and table.weights.dtype == np.int8 and table.weights.nbytes < 16e6
