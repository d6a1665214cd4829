"""Line removal, fill-in-the-middle and spelling variants against brute-force versions, with their edge cases."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shoptally.llm import fill_in_middle, lines, spelling

SCHEMA = "doc_id long, text string, row string, n_lines string, fim string, h long, gone int, word string, k long"
PAD = (("r", "x", "f", 5, 6, "w", 7),)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, *PAD[0]) for i, t in rows], SCHEMA)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def lower(text):
    return text.translate({c: c + 32 for c in range(65, 91)})


def plain_lines(rows, min_docs, min_chars=1):
    holders = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            holders.setdefault(lower(line.strip(" \t\n\x0b\x0c\r")), set()).add(i)
    out = []
    for i, t in rows:
        parts = (t or "").split("\n")
        keys = [lower(x.strip(" \t\n\x0b\x0c\r")) for x in parts]
        kept = [x for x, k in zip(parts, keys, strict=True) if len(k) < min_chars or len(holders[k]) < min_docs]
        out.append((i, "\n".join(kept), len(parts), len(parts) - len(kept)))
    return sorted(out, key=repr)


LINE_ROWS = [
    (0, "Hello \n\tHELLO\r\nÄ b\n"), (1, "hello\nä b\nx"), (2, "hello \n hello\n\n\nend"), (3, None), (4, ""), (5, "\n\n"), (6, "Ä b\nhello"),
    (6, "Ä b\nhello"), (6, "other\nend"), (None, "hello\nend\nnobody"), (None, "nobody"), (None, None), (7, "x\n" * 4000 + "end"), (8, "X\x0b"),
    (9, "K\nk"), (10, "K\nq"),
]


@pytest.mark.parametrize("min_docs,min_chars", [(1, 1), (2, 1), (3, 1), (3, 2), (4, 0)])
def test_lines_equal_brute_force(spark, min_docs, min_chars):
    found = lines.without_frequent_lines(frame(spark, LINE_ROWS), min_docs, min_chars)
    got = sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in found.collect()), key=repr)
    assert got == plain_lines(LINE_ROWS, min_docs, min_chars)
    assert set(found.columns) == {c.strip().split()[0] for c in SCHEMA.split(",")} | {"n_dropped"}
    assert found.filter("row <> 'r' or fim <> 'f' or h <> 6 or gone <> 7 or k is not null and k <> 7").count() in (0, len(LINE_ROWS))


def test_lines_of_an_empty_table_and_other_text_columns(spark):
    empty = frame(spark, LINE_ROWS).limit(0)
    assert lines.without_frequent_lines(empty).count() == 0
    renamed = spark.createDataFrame([(1, "a\nb", "a"), (2, "a", "c")], "doc_id int, body string, text string")
    got = lines.without_frequent_lines(renamed, 2, text_column="body")
    assert sorted((r.doc_id, r.body, r.text, r.n_dropped) for r in got.collect()) == [(1, "b", "a", 1), (2, "", "c", 1)]


def plain_fim(doc_id, text, seed=7, rate=100, spm=50):
    text = text or ""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return doc_id, len(units), "plain", None, None, text
    if h[3] % 100 < spm:
        return doc_id, len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def fim_rows():
    pick = random.Random(4)
    alphabet = "ab\n\n\U0001f600é<>PSM \r"
    rows = [(n, "".join(pick.choice(alphabet) for _ in range(pick.randint(0, 40)))) for n in range(300)]
    long_text = "\n".join(f"line {i}" for i in range(60_000))
    return [*rows, (5, None), (None, "a\nb"), (None, None), (-3, "a\n<M>"), (1001, long_text), (1002, "z" * 300_000), (1003, "\n" * 5000), (1004, "<"), (1004, "<")]


@pytest.mark.parametrize("rate,spm", [(100, 50), (40, 0), (0, 100)])
def test_fill_in_middle_equals_brute_force(spark, rate, spm):
    rows, settings = fim_rows(), fill_in_middle.Settings(rate=rate, spm_rate=spm)
    made = fill_in_middle.fill_in_middle(frame(spark, rows), settings)
    assert made.columns == [c for c in frame(spark, []).columns if c != "fim"] + ["fim"]
    flat = made.select("doc_id", "text", "fim.*").withColumn("back", fill_in_middle.restored(F.col("output"), F.col("form"), settings)).collect()
    got = sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in flat), key=repr)
    assert got == sorted((plain_fim(i, t, rate=rate, spm=spm) for i, t in rows), key=repr)
    assert all(r.back == (r.text or "") for r in flat)


def test_fill_in_middle_of_nothing_and_bad_marks(spark):
    assert fill_in_middle.fill_in_middle(frame(spark, [])).count() == 0
    for marks in (("<P>", "<P>", "<M>"), ("", "b", "c"), ("ab", "bc", "x"), ("abc", "b", "x"), ("aba", "x", "y")):
        with pytest.raises(ValueError):
            fill_in_middle.Settings(prefix=marks[0], suffix=marks[1], middle=marks[2])


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_spelling(rows, shortest=5, least=3):
    counts = {}
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] = counts.get(run, 0) + 1
    counts = {w: n for w, n in counts.items() if len(w) >= shortest and n >= least}
    near = {w: [x for x in counts if one_edit(w, x)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best and counts[best] >= 2 * counts[w] else None

    def root(w):
        return root(form[w]) if form[w] else w

    return sorted(((w, form[w], root(w), counts[w], len(near[w]), counts.get(form[w])) for w in counts), key=repr)


def spelling_rows():
    pick, rows = random.Random(9), []
    for n in range(400):
        words = ["".join(pick.choice("aabBÉé") for _ in range(pick.randint(4, 8))) for _ in range(60)]
        rows.append((n, " ".join(words) + pick.choice([".", "\n", "ÿ×3x"])))
    return [*rows, (1, None), (None, "chain chain chain"), (None, "chains " * 9 + "chainss " * 30 + "chaiinss " * 90), (3, ""), (3, "x" * 400 + " " + "x" * 401), (4, ("y" * 3000 + " ") * 3 + ("y" * 3001 + " ") * 7)]


def test_spelling_equals_brute_force(spark):
    rows = spelling_rows()
    found = spelling.spelling_variants(frame(spark, rows))
    got = sorted(((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in found.collect()), key=repr)
    want = plain_spelling(rows)
    assert got == want and len({r[2] for r in want}) < len(want) and any(r[1] and r[1] != r[2] for r in want)


def test_spelling_of_an_empty_table(spark):
    assert spelling.spelling_variants(frame(spark, [])).count() == 0


@pytest.mark.parametrize("slice_rows", [3, 40])
def test_crowded_keys_are_dealt_over_cells(spark, slice_rows):
    pick = random.Random(2)
    vocabulary = sorted({"".join(pick.choice("ab") for _ in range(pick.randint(1, 7))) for _ in range(400)})
    words = spark.createDataFrame([(w, pick.randint(1, 9)) for w in vocabulary], "word string, n long")
    near = {r.word: r.n_near for r in spelling.near_words(words, slice_rows=slice_rows).collect()}
    want = {w: sum(one_edit(w, x) for x in vocabulary) for w in vocabulary}
    assert near == {w: n for w, n in want.items() if n}


def test_prefixes_and_suffixes_of_blocks():
    words = ["".join(w) for k in range(1, 4) for w in itertools.product("ab", repeat=k)] + ["\U0001f600é"]
    matrix, flipped = spelling.code_points(words, 3)[None], spelling.code_points(words, 3, right=True)[None]
    prefix, suffix = spelling.common(matrix, matrix, range(3)), spelling.common(flipped, flipped, range(2, -1, -1))
    for (i, a), (j, b) in itertools.combinations(enumerate(words), 2):
        assert (prefix[0, i, j] + suffix[0, i, j] >= max(len(a), len(b)) - 1 and abs(len(a) - len(b)) < 2) == one_edit(a, b)
    none = pd.DataFrame({"cell": np.zeros(0, int), "size": np.zeros(0, int), "segment": np.zeros(0, int), "word": [], "slice": np.zeros(0, int), "alone": np.zeros(0, bool)})
    assert len(spelling.near_pairs(none)[0]) == 0
