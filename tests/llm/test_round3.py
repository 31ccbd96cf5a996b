"""Language identification, the Merkle manifest and cross-tokenizer alignment against plain versions."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidelake.llm import alignment, language_id, merkle, passages, registry, warc

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = "leaf altered g n idx seg level __mid __part __row __all first before to more digest held_out lang_pred score n_a n_b n_groups n_links groups_sha256 pairs times pair best n_best count_sum".split()
SF = "/root/testdata/sf0.001"


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("clash") for c in CLASH})


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def merkle_plain(rows):
    """doc_id, leaf, subroot, root, proof, folded root, verified of each row, by recursion over lists."""

    def field(x):
        return "-" if x is None else f"{len(str(x).encode())}:{x}"

    def leaf(r, more=0):
        return h(*map(field, (r[0], r[3], r[2], None if r[4] is None else r[4] + more, r[1])))

    def ways(digests):
        """The root and each leaf's steps."""
        if len(digests) == 1:
            return digests[0], [[]]
        runs = [digests[i : i + 2] for i in range(0, len(digests), 2)]
        root, up = ways([h(*r) for r in runs])
        own = [("LR"[1 - i % 2], runs[i // 2][1 - i % 2]) if len(runs[i // 2]) == 2 else None for i in range(len(digests))]
        return root, [[own[i], *up[i // 2]] for i in range(len(digests))]

    langs = {}
    for r in rows:
        langs.setdefault(r[2], []).append(r)
    order = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    trees = []
    for lang in order:
        group = sorted(langs[lang], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees.append((group, *ways([leaf(r) for r in group])))
    if not trees:
        return []
    root, up = ways([t[1] for t in trees])
    out = []
    for (group, subroot, steps), more in zip(trees, up):
        for r, way in zip(group, steps):
            way = [s for s in [*way, *more]]
            got = leaf(r, int(r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0))
            for s in way:
                got = h(got) if s is None else h(s[1], got) if s[0] == "L" else h(got, s[1])
            out.append((r[0], leaf(r), subroot, root, h(*(s[1] for s in way if s)), got, got == root))
    return out


def same_rows(got, want):
    return sorted(map(repr, got)) == sorted(map(repr, want))


@pytest.mark.parametrize("block, small", [(10, 1 << 20), (2, 0)])
def test_merkle_against_lists(spark, block, small):
    rng = random.Random(block)
    texts = [None, "", " \n", "é中", "x" * 200_000, "a b", "a b"]
    rows = [(rng.choice([None, *range(60)]), rng.choice(texts), rng.choice([None, "en", "en", "en", "é", "z", "zz"]), rng.choice([None, "", "s"]), rng.choice([None, 0, 7, -3])) for _ in range(90)]
    rows += [rows[0]] * 40 + [(1000, "alone", "alone", "s", 5)]
    made = table(spark, rows).repartition(5)
    got = merkle.prove(made, merkle.tampered_rows(), block, small).drop("proof").collect()
    assert same_rows(map(tuple, got), merkle_plain(rows))


@pytest.mark.parametrize("rows", [[], [(None, None, None, None, None)], [(7, "one", "en", "s", 3)], [(i, "t", f"l{i}", "s", 1) for i in range(5)]])
def test_merkle_small_tables(spark, rows):
    got = merkle.prove(table(spark, rows), merkle.tampered_rows()).drop("proof").collect()
    assert same_rows(map(tuple, got), merkle_plain(rows))


def test_merkle_proofs_hold_alone(spark):
    """A row's leaf and its proof lead to the root without the table; another leaf doesn't."""
    rows = [(i, f"text {i}", "en" if i % 3 else None, "s", i) for i in range(40)]
    for r in merkle.prove(table(spark, rows), F.lit(False)).collect():
        assert merkle.fold(r["leaf"], bytes(r["proof"]))[0] == r["root"] and r["verified"]
        assert merkle.fold(h("x"), bytes(r["proof"]))[0] != r["root"]


def plain_grams(text):
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    return Counter(x for w in words for x in zip("\0" + w, w, w[1:] + "\0"))


def plain_bundle(text, dims):
    total = np.zeros(dims)
    for (a, b, c), n in plain_grams(text).items():
        v = language_id.letter_vectors(np.array([ord(a), ord(b), ord(c)]), dims).astype(float)
        total += n * np.roll(v[0], 2) * np.roll(v[1], 1) * v[2]
    return total


def test_language_bundles_against_plain_sums(monkeypatch):
    texts = ["", "a", "Ab ab!", "été à l'œuvre", "12 34", "x" * 3000, "日本語 text", "İ Straße ǅ", "\n\n", "the cat\nsat"]
    want = np.array([plain_bundle(t, 128) for t in texts])
    assert np.array_equal(language_id.bundles(texts, 128), want)
    monkeypatch.setattr(language_id, "DENSE", 0)  # the way for large alphabets
    monkeypatch.setattr(language_id, "CELLS", 1)  # a text at a time
    assert np.array_equal(language_id.bundles(texts, 128), want)


def test_language_vectors_are_random_signs():
    v = language_id.letter_vectors(np.arange(97, 123)).astype(float)
    cosines = v @ v.T / v.shape[1]
    assert set(np.unique(v)) == {-1.0, 1.0} and np.abs(cosines - np.eye(26)).max() < 0.15


def test_language_against_plain_prototypes(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    out = {r["doc_id"]: zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1 for r in rows}
    sums = {}
    for r in rows:
        if not out[r["doc_id"]] and r["lang"] is not None:
            sums[r["lang"]] = sums.get(r["lang"], 0) + plain_bundle(r["text"] or "", language_id.DIMS)
    got = {r["doc_id"]: r for r in registry.QUERIES["op11_language_id"](spark, SF).collect()}
    assert set(got) == set(out)
    for r in rows:
        b = plain_bundle(r["text"] or "", language_id.DIMS)
        cosines = {k: float(b @ s / np.linalg.norm(b) / np.linalg.norm(s)) if b.any() else 0.0 for k, s in sums.items()}
        mine = got[r["doc_id"]]
        assert mine["held_out"] == out[r["doc_id"]]
        if not any(c.isalpha() for c in r["text"] or ""):
            assert (mine["lang_pred"], mine["score"]) == ("und", 0.0)
        else:
            best = max(cosines.values())
            assert abs(cosines[mine["lang_pred"]] - best) < 1e-9 and abs(mine["score"] - max(0.0, best)) < 1e-6


def test_language_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    held = [r for r in registry.QUERIES["op11_language_id"](spark, sf_dir).collect() if r["held_out"] and lang[r["doc_id"]] is not None]
    assert len(held) > 250 and sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.99 * len(held)


def test_language_edges(spark):
    rows = [(None, "the end", "en", None, None), (2, None, "en", None, None), (3, "", None, None, None), (4, "12 !", "en", None, None), (5, "le chat", "fr", None, None), (5, "le chat", "fr", None, None), (6, "the", None, None, None), (8, "é" * 100_000, "", None, None)]
    d = table(spark, rows)
    got = language_id.classify(d, *language_id.fit(d)).collect()
    assert len(got) == len(rows) and {r["lang_pred"] for r in got if r["doc_id"] in (2, 3, 4)} == {"und"}
    assert [r["held_out"] for r in got if r["doc_id"] is None] == [False] and len({tuple(r) for r in got if r["doc_id"] == 5}) == 1
    assert all(0 <= r["score"] <= 1 for r in got)
    empty = d.limit(0)
    assert language_id.classify(empty, *language_id.fit(empty)).count() == 0
    unlearned = language_id.classify(d, *language_id.fit(empty)).collect()
    assert {(r["lang_pred"], r["score"]) for r in unlearned} == {("und", 0.0)}
    with pytest.raises(ValueError):
        language_id.fit(d, most=1)


def paths():
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json")), str(public_tokenizers.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def encoders():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(paths()[0])
    a.encode_special_tokens = True
    table = alignment.byte_of()
    return a, [bytes(table[c] for c in a.id_to_token(i)) if i != 50256 else b"<|endoftext|>" for i in range(a.get_vocab_size())], SentencePieceProcessor(model_file=paths()[1])


def plain_groups(encoders, text):
    """The groups of a text, each as lists of A's and B's ids."""
    a, bytes_a, b = encoders
    if not text:
        return []
    ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    pieces = [b.id_to_piece(i) for i in ids[1]]
    raw = [bytes_a[i] for i in ids[0]], [bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode() for p in pieces]
    if any(b"".join(x) != (" " + text).encode() for x in raw):
        return []
    ends = [np.cumsum([len(x) for x in y]).tolist() for y in raw]
    out, i, j = [], 0, 0
    for c in sorted(set(ends[0]) & set(ends[1])):
        k, m = ends[0].index(c, i) + 1, ends[1].index(c, j) + 1
        out.append((ids[0][i:k], ids[1][j:m]))
        i, j = k, m
    return out


def told(groups):
    return ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)


def links(groups):
    return Counter((x, y) for a, b in groups for x in a for y in b)


def strange_texts(n, seed):
    rng = random.Random(seed)
    pool = list(" \n") * 12 + [chr(c) for c in range(33, 127)] * 3 + list("éèßñÑüÄ中文字日本𐍈😀👍🏽ﬁ½²́‍") + ["<|endoftext|>", "<s>", "<0x0A>", "<unk>", "'s", "'ll", "the", " of", "ing"]
    odd = pool + list("\xa0\t▁\r\x00 　٣�\x1c\x85")
    return ["".join(rng.choice(odd if k % 4 == 0 else pool) for _ in range(rng.randrange(0, 40))) for k in range(n)]


def test_alignment_of_strange_texts(encoders):
    own = alignment.Aligner(*paths(), remembered=3000)  # units are dropped and learned again
    texts = strange_texts(6000, 1) + ["x!" * 50_000, "word " * 2000, " ", "\n", " \n ", "a  ", "\n\n a", "日本" * 5000]
    for at in range(0, len(texts), 500):
        some = texts[at : at + 500]
        got, start = own.align(some), 0
        for k, text in enumerate(some):
            groups, stop = plain_groups(encoders, text), int(got["ends"][k])
            assert got["told"][k].decode() == told(groups), text[:80]
            assert [int(got[x][k]) for x in ("a", "b", "groups", "links")] == [sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), sum(len(a) * len(b) for a, b in groups)]
            assert {(p >> 20, p & 0xFFFFF): t for p, t in zip(got["pairs"][start:stop].tolist(), got["times"][start:stop].tolist())} == links(groups)
            start = stop


def test_alignment_counts_equal_ids_first_in_crowded_groups():
    ids_a, ids_b = np.array([1, 2] * 500 + [3]), np.array([5] * 400 + [6, 5])
    group_a, group_b = np.repeat([0, 1], [1000, 1]), np.repeat([0, 1], [401, 1])
    got = alignment._linked(ids_a, ids_b, group_a, group_b, np.bincount(group_a), np.bincount(group_b))
    assert sorted(zip(*(x.tolist() for x in got))) == [(1, 5, 0, 200_000), (1, 6, 0, 500), (2, 5, 0, 200_000), (2, 6, 0, 500), (3, 5, 1, 1)]


def alignment_plain(encoders, rows):
    all_groups = [plain_groups(encoders, t) for _, t in rows]
    counts = Counter(p for g in all_groups for p in links(g))
    best = {}
    for (a, _), n in counts.items():
        best[a] = max(best.get(a, 0), n)
    out = []
    for (i, _), g in zip(rows, all_groups):
        own = links(g)
        sums = sum(n for p, n in own.items() if counts[p] == best[p[0]]), sum(n * counts[p] for p, n in own.items())
        out.append((i, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(own.values()), h(told(g)) if g else "", *sums))
    return out


@pytest.mark.parametrize("sent", [alignment.SENT, 0])
def test_alignment_query_against_plain_counts(spark, encoders, sent):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = alignment.query(spark, SF, sent=sent).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum").collect()
    assert same_rows(map(tuple, got), alignment_plain(encoders, rows))


@pytest.mark.parametrize("sent", [alignment.SENT, 0])
def test_alignment_edges(spark, encoders, sent):
    rows = [(None, "the end"), (2, None), (3, ""), (4, " \n"), (5, "le chat"), (5, "le chat"), (6, "a▁b"), (7, "日本 😀!"), (8, "x!" * 60_000)]
    d = table(spark, [(i, t, None, None, None) for i, t in rows])
    made = alignment.materialise(alignment.align(d, *paths(), groups=True).withColumn("__row", F.monotonically_increasing_id()), "test")
    got = alignment.score(made, alignment.pair_counts(made, held=2), sent)
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]
    assert same_rows(map(tuple, got.select(*names).collect()), alignment_plain(encoders, rows))
    assert all((h(r["groups"]) if r["groups"] else "") == r["groups_sha256"] for r in got.collect())
    none = alignment.materialise(alignment.align(d.limit(0), *paths()).withColumn("__row", F.monotonically_increasing_id()), "test")
    assert alignment.score(none, alignment.pair_counts(none), sent).count() == 0


def test_index_merge_in_ranges_of_bounded_size(spark):
    """One URL has most captures, one capture is in many runs; no range holds more than a few times what it should."""
    rows = [(7 if i % 5 == 0 else i, "http://hot.example/" if i % 3 else f"http://h{i % 17}.example/{i}", f"<p>{i}</p>") for i in range(3000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(12)
    merged = warc.merge_index(warc.read_archives(warc.materialise(warc.write_archives(pages), "archives")), per_range=100)
    parts = merged.select("url_key", "captured_at", "page_id", F.spark_partition_id().alias("part")).collect()
    keys = [(r["url_key"], r["captured_at"], r["page_id"]) for r in sorted(parts, key=lambda r: r["part"])]
    sizes = Counter(r["part"] for r in parts)
    assert len(parts) == 3000 and len(sizes) > 20 and max(sizes.values()) < 1000
    assert keys == sorted(keys)


def test_groups_of_passages(spark):
    found = spark.createDataFrame([(5, 9, "passage"), (9, 2, "passage"), (7, 8, "copy"), (8, 11, "passage"), (5, 2, "passage")], "doc_id long, twin_id long, kind string")
    assert {(r["doc_id"], r["group_id"]) for r in passages.groups(found).collect()} == {(2, 2), (5, 2), (9, 2), (7, 7), (8, 7), (11, 7)}
    assert passages.groups(found.limit(0)).count() == 0
