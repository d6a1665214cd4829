"""Operators of the training-data part: edge cases, and brute-force versions on a small fixture."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import tokenizers
from oracle import compare, connect
from pyspark.sql import functions as F

import public_tokenizers
from shoptally.llm import byte_pairs, chat, components, languages, packing, personal_data, quality, registry, simhash, substrings, topk, training_order
from shoptally.llm.word_tokens import WordIds, document_ids

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words string, tag int, _parts string"


def passage(n, seed):
    pick = random.Random(seed)
    return " ".join("".join(pick.choice("abcdefgh") for _ in range(pick.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    shared = passage(60, 1)
    return [
        (0, passage(80, 2)), (1, passage(30, 3) + " " + shared), (2, shared + "\n" + passage(40, 4)), (3, None), (4, ""), (5, " \t\n"),
        (6, passage(80, 2)), (6, passage(80, 2)), (6, passage(10, 5)), (None, shared), (None, None), (7, passage(3000, 6)),
        (8, passage(80, 2).upper()), (9, "mail a.b@c.de or +1 (152) 555-8590, host 10.0.0.1, card 4111 1111 1111 1111"), (10, "Die ǘ \U0001F600 x\x85y"),
    ]


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame([(i, t, None if n % 5 == 0 else "en", "s", 1, "x", 7, "y") for n, (i, t) in enumerate(texts)], SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return SPACE.findall(text or "")


@pytest.mark.parametrize("name", sorted(registry.oracles()))
def test_equals_sql(spark, sf, name):
    problem, _ = compare(registry.queries()[name](spark, sf), connect(sf), registry.oracles()[name])
    assert not problem


def plain_fingerprint(text):
    w = words((text or "").translate({c: c + 32 for c in range(65, 91)}))
    shingles = [" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    hashes = [simhash.xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(docs, texts, none):
    found = simhash.near_duplicates(simhash.keyed(docs)).collect()
    prints = [plain_fingerprint(t) for _, t in texts]
    groups = list(range(len(prints)))
    for a in range(len(prints)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 4 and groups[a] != groups[b]:
                old = groups[a]
                groups = [groups[b] if g == old else g for g in groups]
    least = {g: min((i for (i, _), h in zip(texts, groups, strict=True) if h == g and i is not None), default=None) for g in set(groups)}
    want = sorted(((i, p, least[g]) for (i, _), p, g in zip(texts, prints, groups, strict=True)), key=repr)
    assert sorted(((r.doc_id, r.fp % (1 << 64), r.component_id) for r in found), key=repr) == want
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(groups))
    assert simhash.near_duplicates(simhash.keyed(none)).count() == 0 and simhash.keep_one(none).count() == 0


def test_links_miss_no_pair(spark):
    pick = np.random.default_rng(3)
    base = pick.integers(0, 1 << 63, 40, dtype=np.uint64)
    rows = {int(x) for b in base for x in [b, *(b ^ sum((np.uint64(1) << np.uint64(i) for i in pick.choice(64, n, False)), np.uint64(0)) for n in (1, 2, 3, 4, 4, 5, 7))]}
    signed = [(int(np.uint64(x).view(np.int64)),) for x in rows]
    roots = {r.vertex % (1 << 64): r.root % (1 << 64) for r in components.components(simhash.links(spark.createDataFrame(signed, "fp long"))).collect()}
    for a in rows:
        for b in rows:
            if a != b and (a ^ b).bit_count() <= 4:
                assert roots[a] == roots[b]


def test_crowded_keys_are_tiled(spark):
    keys = spark.createDataFrame([(1, x) for x in range(50)] + [(2, 7)], "key long, fp long")
    cells = simhash.tiled(keys, tile=10).collect()
    members = {}
    for r in cells:
        members.setdefault((r.key, r.cell), set()).add(r.fp)
    together = {(a, b) for s in members.values() for a in s for b in s}
    assert all((a, b) in together for a in range(50) for b in range(50)) and max(map(len, members.values())) < 40


def plain_removal(texts):
    starts = {}
    for i, t in texts:
        w, key = words(t), substrings.NO_ID if i is None else i
        for p in range(len(w) - 49):
            window = tuple(w[p : p + 50])
            starts[window] = min(starts.get(window, key), key)
    out = []
    for i, t in texts:
        w, key = words(t), substrings.NO_ID if i is None else i
        gone = {q for p in range(len(w) - 49) if starts[tuple(w[p : p + 50])] < key for q in range(p, p + 50)}
        kept = " ".join(x for q, x in enumerate(w) if q not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_substrings(docs, texts, none):
    assert sorted(map(tuple, substrings.removal_report(docs).collect()), key=repr) == plain_removal(texts)
    cut = substrings.without_repeats(docs)
    assert cut.columns == docs.columns and cut.count() == len(texts)
    assert substrings.removal_report(none).count() == 0


def test_substrings_of_repeated_rows(spark):
    """Rows without an id, and rows that repeat an id and a text, each many times; edges of passages; a very long text."""
    shared, long = passage(70, 11), passage(20_000, 12)
    rows = [(1, long), (2, passage(9, 13) + " " + shared), (3, shared + " " + " ".join(long.split()[500:7000]))]
    rows += [(4, shared)] * 40 + [(None, shared + " end")] * 40 + [(None, passage(80, 14))] * 3
    found = substrings.removal_report(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, found.collect()), key=repr) == plain_removal(rows)
    runs = spark.createDataFrame([(4, 9, 0, 5)] * 30 + [(4, 9, 5, 2)], "doc long, tag long, first int, n int")
    assert sorted(map(tuple, substrings.parts_of(runs).first().parts)) == [(0, 5), (5, 2)]


def test_only_repeated_halves_are_extended(spark):
    rows = spark.createDataFrame([(1, 1, passage(300, 15)), (2, 2, passage(60, 16)), (3, 3, passage(60, 16))], "doc long, tag long, text string")
    half = substrings.seeds(rows)
    again = half.groupBy("seed").agg(F.countDistinct("doc").alias("docs")).filter("docs > 1")
    extended = substrings.stretches(rows, half.join(again, "seed", "left_semi").drop("seed"))
    assert {r.doc for r in half.collect()} == {1, 2, 3} and {r.doc for r in extended.collect()} == {2, 3}
    alike = substrings.windows(rows, extended.select("doc", "tag", "first", "n")).groupBy("first").agg(F.countDistinct("window").alias("n"))
    assert [r.n for r in alike.collect()] == [1] * 11


def test_quality(docs, none, texts):
    rows = {(r.doc_id, r.n_words): r for r in quality.judge(docs).collect()}
    for i, t in texts:
        assert rows[i, len(words(t))].base_failed == (len(words(t)) < 20)
    assert quality.judge(none).count() == 0 and quality.keep_good(docs).columns == docs.columns


def test_personal_data(docs, none):
    row = personal_data.personal_data(docs).filter("doc_id = 9").first()
    assert (row.n_email, row.n_ip, row.n_card, row.n_phone) == (1, 1, 1, 1)
    text = personal_data.redacted(docs).filter("doc_id = 9").first().text
    assert text == "mail <EMAIL> or <PHONE>, host <IP>, card <CARD>"
    assert personal_data.personal_data(none).count() == 0


def luhn(digits):
    doubled = [int(c) * (1 + n % 2) for n, c in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def plain_base(text):
    """Counts of the four kinds, and the base spans as they are reported, from the patterns alone."""
    text, spans, counts = text or "", [], []
    for kind, pattern, valid in (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(re.sub("[ -]", "", m)) <= 19 and luhn(re.sub("[ -]", "", m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 15),
    ):
        found = [f"{kind}:{m.start()}:{m.end()}" for m in re.finditer(pattern, text) if valid(m[0])]
        spans += found
        counts.append(len(found))
    return counts, spans


def test_base_spans_of_all_documents(spark):
    """Counts and digest of every document and of random strings; each base span is among the reported ones."""
    pick = random.Random(21)
    parts = ["4111 1111 1111 1111", "4111-1111", "+1 (152) 555-8590", "10.0.0.1", "300.1.2.3", "a.b@c.de", "@", ".", "1", "23", " ", "-", "+", "x", "\n", "é", "\U0001F600"]
    noise = [(100_000 + n, "".join(pick.choice(parts) for _ in range(pick.randint(0, 40)))) for n in range(3000)]
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(spark.createDataFrame(noise, docs.schema))
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = personal_data.personal_data(docs).collect()
    assert len(rows) == len(texts)
    for r in rows:
        counts, spans = plain_base(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == counts
        assert r.base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest() and set(spans) <= set(r.spans.split(","))


@pytest.mark.parametrize("text", ["a@b.c@d.ef x@y", "1.2.3.4.5.6.7.8 999.1.1.1", "4111-1111 1111 1111", "+1+2 555 0000000", "@@a@b..c"])
def test_exact_spans_are_the_patterns(text):
    emails = [m.span() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    ips = [m.span() for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    found = personal_data.exact_spans(text)
    assert [s[1:] for s in found if s[0] == 0] == emails and [s[1:] for s in found if s[0] == 1] == ips


def test_word_ids_are_the_library_s():
    ids = WordIds(packing.vocabulary_path())
    pick = random.Random(5)
    parts = ["a", "The", "ing", " ", "\n", "\x85", "\xa0", "é", "́", "İ", "Σ", "12", ".", ",", "'s", "...", "<|endoftext|>", "가"]
    for _ in range(2000):
        text = "".join(pick.choice(parts) for _ in range(20))
        assert list(document_ids(text, ids, 2)) == ids.tokenizer.encode(text, add_special_tokens=False).ids + [2]


def test_ids_of_many_texts_are_the_library_s():
    ids = WordIds(packing.vocabulary_path())
    pick = random.Random(6)
    parts = ["a", "The", "ing", " ", " ", "\n", "\x85", "\xa0", "\x1c", "é", "É", "ß", "µ", "×", "́", "̸", "İ", "Σ", "1", ".", ">", "'s", "'!", "…", "<|endoftext|>", "</w>", "가"]
    texts = [None, "", " \n"] + ["".join(pick.choice(parts) for _ in range(pick.randint(0, 20))) for _ in range(2000)]
    found, at = ids.encode_texts(pa.array(["left out", *texts])[1:])
    for i, text in enumerate(texts):
        assert found[at[i] : at[i + 1]].tolist() == ids.tokenizer.encode(text or "", add_special_tokens=False).ids
    assert at[-1] == len(found) and not ids.known
    for nothing in ([], [None, ""]):
        found, at = ids.encode_texts(pa.array(nothing, pa.string()))
        assert len(found) == 0 and at.tolist() == [0] * (len(nothing) + 1)


def test_slices_hold_every_row_once():
    sizes = [0, 5, 3, 40, 0, 2, 2, 2, 9, 10]
    batch = pa.record_batch({"doc_id": range(len(sizes) + 1), "text": [*["x" * n for n in sizes], None]})
    parts = list(training_order.slices(batch[1:], 10))
    assert [r for p in parts for r in p.column(0).to_pylist()] == list(range(1, len(sizes) + 1))
    texts = [[len(t or "") for t in p.column(1).to_pylist()] for p in parts]
    assert all(sum(t) <= 10 or len(t) == 1 for t in texts) and len(parts) == 5


LIBRARY = tokenizers.Tokenizer.from_file(packing.vocabulary_path())


def library_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids + [2]


def plain_pieces(texts, size):
    """(doc_id, start, length, crc32 of the ids, ids of the document) of every run of ``size`` ids, by the tokenizer library."""
    out = []
    for i, t in texts:
        ids = np.array(library_ids(t), dtype="<u4")
        out += [(i, at, len(ids[at : at + size]), zlib.crc32(ids[at : at + size].tobytes()), len(ids)) for at in range(0, len(ids), size)]
    return sorted(out, key=lambda r: (r[0] is None, r[0] or 0, *r[1:]))


def windows_are_gapless(rows, capacity):
    spaces = {}
    for r in rows:
        spaces.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in spaces.values():
        parts.sort()
        if [o for o, _ in parts] != list(np.cumsum([0] + [n for _, n in parts])[:-1]) or sum(n for _, n in parts) > capacity:
            return False
    return True


@pytest.mark.parametrize("capacity", [16, 4096])
def test_packing(docs, none, texts, capacity):
    rows = packing.pack(docs, packing.vocabulary_path(), capacity).collect()
    found = sorted(((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, *r[1:]))
    assert found == plain_pieces(texts, capacity) and windows_are_gapless(rows, capacity)
    assert packing.pack(none, packing.vocabulary_path()).count() == 0


def test_best_fill_is_the_best():
    pick = random.Random(1)
    for _ in range(200):
        left = {pick.randint(1, 30): pick.randint(1, 3) for _ in range(4)}
        sums = {0}
        for size, n in left.items():
            sums = {s + k * size for s in sums for k in range(n + 1)}
        target = pick.randint(1, 60)
        counts = packing.best_fill(target, left)
        assert sum(k * n for k, n in counts.items()) == max(s for s in sums if s <= target) and all(n <= left[k] for k, n in counts.items())


def test_training_order(spark, docs, none, tmp_path, texts):
    found = training_order.materialise(docs, str(tmp_path / "a"), packing.vocabulary_path(), length=64, per_shard=16).collect()
    assert sorted(r.slot for r in found) == list(range(len(found))) and all(r.shard == r.slot // 16 and len(r.record) == 128 for r in found)
    ids = sorted((str(r.doc_id), r.start, r.n_tokens, zlib.crc32(np.frombuffer(r.record, "<u2")[: r.n_tokens].astype("<u4").tobytes())) for r in found)
    assert ids == sorted((str(i), at, n, crc) for i, at, n, crc, _ in plain_pieces(texts, 64))
    assert not any(any(r.record[2 * r.n_tokens :]) for r in found)
    files = sorted((tmp_path / "a").glob("shard=*/*.parquet"))
    assert len(files) == (len(found) + 15) // 16 == len({f.parent for f in files})
    for f in files:  # in slot order as they lie on disk
        slots = pq.ParquetFile(f).read(["slot"])["slot"].to_pylist()
        assert slots == list(range(slots[0], slots[0] + len(slots)))
    assert training_order.read_shards(spark, str(tmp_path / "a"), 20, 16).count() == len(found) - 20
    assert training_order.materialise(none, str(tmp_path / "b"), packing.vocabulary_path()).count() == 0
    assert all(sorted(training_order.permuted(np.arange(n), n)) == list(range(n)) for n in (1, 2, 5, 1000))


def test_languages(spark, none):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = languages.op9_languages(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").filter("held_out")
    right, total = found.agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("double")), F.count("*")).first()
    assert total > 200 and right > 0.98
    assert languages.predict(none, languages.train(none, languages.piece_path()), languages.piece_path()).count() == 0


def test_forward_sums_all_segmentations():
    known = type("Known", (), {"numbers": {"a": 1, "b": 2, "ab": 3, "aa": 4}, "count": 5, "spans": languages.Pieces.spans})()
    p = np.array([[0.1], [0.2], [0.3], [0.25], [0.15], [0.0]])
    at = languages.forward(known.spans(["aab"]), p)[-1, 0, 0]
    assert at == pytest.approx(0.2 * 0.2 * 0.3 + 0.15 * 0.3 + 0.2 * 0.25)


@pytest.fixture(scope="module")
def pairs():
    return byte_pairs.loaded(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def test_byte_pairs_are_the_library_s(pairs):
    import tiktoken

    want = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=dict(pairs.ranks), special_tokens={})
    pick = random.Random(7)
    parts = ["a", "aa", " ", "  ", "\n", "\x1c", "\x85", "\xa0", "中", "\U0001F600", "12", "!!", "'ll", "ing", "the", "́"]
    for _ in range(2000):
        text = "".join(pick.choice(parts) for _ in range(25))
        assert list(pairs.encode(text)) == want.encode_ordinary(text) and pairs.decode(pairs.encode(text)) == text.encode()
    for long in ("ab" * 3000, "a" * 5001, "-" * 4099):
        assert list(pairs.encode(long)) == want.encode_ordinary(long)


def test_round_trip(docs, none, texts):
    rows = byte_pairs.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    want = sorted(hashlib.sha256((t or "").encode()).hexdigest() for _, t in texts)
    assert sorted(r.decoded_sha256 for r in rows.collect()) == want


def test_topk_edges(spark):
    inf = float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [None, 1.0]), (4, [inf, 0.0]), (5, None), (None, [9.0, 9.0]), (6, [5.0])]
    vectors = topk.integer_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    found = topk.search(vectors.filter("vec_id = 0"), vectors, 2).orderBy("rank").collect()
    assert [tuple(r) for r in found] == [(0, 1, 1, 1024 * 1024), (0, 2, 2, 1024 * 1024)]
    assert topk.search(vectors.filter("vec_id > 99"), vectors).count() == 0


def test_reply_trees(spark):
    rows = [(1, 1, None, "user", "q", 0.0), (1, 2, 1, "assistant", "</s>\\1", 1.0), (1, 3, 1, "assistant", "b", 2.0), (1, 4, 3, None, None, None), (2, 1, 2, "user", "x", 0.0), (2, 2, 1, "user", "y", 0.0)]
    nodes = spark.createDataFrame(rows, "tree long, node long, parent long, role string, text string, score double")
    found = {r.branch: r.formatted for r in chat.format_trees(nodes).collect()}
    assert found == {1: "<s>user\nq</s>\n<s>assistant\nb</s>\n<s>\n</s>\n", 2: "<s>user\nq</s>\n<s>assistant\n\\1\\01</s>\n"}
    assert chat.format_trees(nodes, 1).count() == 1 and chat.format_trees(nodes.limit(0)).count() == 0


def test_pipeline(spark, sf):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    good = {r.doc_id for r in quality.judge(docs).filter("kept").collect()}
    texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id in good}
    prints = {i: plain_fingerprint(t) for i, t in texts.items()}
    group = {i: i for i in sorted(prints)}
    for a in sorted(prints):
        for b in sorted(prints):
            if (prints[a] ^ prints[b]).bit_count() <= 4 and group[a] != group[b]:
                low, high = sorted((group[a], group[b]))
                group = {i: low if g == high else g for i, g in group.items()}
    kept = [(i, texts[i]) for i in sorted(set(group.values()))]
    starts = {}
    for i, t in kept:
        for p in range(len(words(t)) - 49):
            starts.setdefault(tuple(words(t)[p : p + 50]), i)
    cut = []
    for i, t in kept:
        w = words(t)
        gone = {q for p in range(len(w) - 49) if starts[tuple(w[p : p + 50])] < i for q in range(p, p + 50)}
        cut.append((i, " ".join(x for q, x in enumerate(w) if q not in gone) if gone else t))
    assert any(a != b for a, b in zip(cut, kept, strict=True)) and len(kept) < len(good) < docs.count()
    clean = {r.doc_id: r.text for r in personal_data.redacted(spark.createDataFrame(cut, "doc_id long, text string")).collect()}
    got = corpus_pipeline.run(spark, sf).collect()
    assert sorted((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == plain_pieces(clean.items(), 4096)
    assert windows_are_gapless(got, 4096)
    assert not any(sum(plain_base(t)[0]) for t in clean.values()) and any(clean[i] != t for i, t in cut)
