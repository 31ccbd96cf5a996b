import hashlib
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from tidelake.llm import base, bitmap, chat, exact_dedup, likelihood, mixing, near_dedup, packing, passages, quality, registry, telephony, warc

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
DIR = "/root/testdata/sf0.001"


def docs(spark, texts, ids=None, sources=None):
    rows = [(i if ids is None else ids[i], t, "en", None if sources is None else sources[i], 0) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


EDGE = [None, "", "  \n", "a", "A\tb", "a b", "a  b ", "x" * 50_000, "word " * 3000, "a b", "İ ΑΣ. é <|endoftext|> don't!!"]


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_equals_sql(spark, name):
    got = registry.QUERIES[name](spark, DIR)
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    names = sorted(got.columns)
    assert sorted(map(tuple, got.select(*names).collect()), key=repr) == sorted(con.sql(registry.SQL[name]).select(*names).fetchall(), key=repr)


def test_exact_dedup_edges_and_collisions(spark):
    from pyspark.sql import functions as F

    d = docs(spark, [*EDGE, "a b"], [*range(10), None, 9]).withColumn("keep_id", F.lit("clash"))
    for digest in (exact_dedup._sha256, lambda norm: F.unhex(F.substring(F.sha2(norm, 256), 1, 1).cast("string") if False else F.lpad(F.substring(F.sha2(norm, 256), 1, 1), 2, "0"))):
        got = exact_dedup.mark(d, digest=digest).collect()
        groups = {}
        for r in d.collect():
            groups.setdefault("".join(c for c in r["text"] or "" if c not in " \t\n\x0b\x0c\r"), []).append(r)
        assert len(got) == 12 and sum(r["kept"] for r in got) == len(groups)
        for norm, members in groups.items():
            best = min(members, key=lambda r: (-len(r["text"] or ""), r["doc_id"] is None, r["doc_id"] or 0))
            mine = [r for r in got if r["text_sha256"] == hashlib.sha256(norm.encode()).hexdigest()]
            assert {(r["keep_id"], r["group_size"]) for r in mine} == {(best["doc_id"], len(members))} and len(mine) == len(members)
    assert exact_dedup.keep(d).columns == d.columns and exact_dedup.keep(d).count() == len(groups)
    assert exact_dedup.mark(d.limit(0)).count() == 0


def test_packing_brute_force(spark):
    path = packing.tokenizer_path()
    texts = EDGE + ["The quick brown fox, 123 times. " * 700]
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    ids = {i: t.encode(x or "", add_special_tokens=False).ids + [1] for i, x in enumerate(texts)}
    pieces = packing.pack(docs(spark, texts), path)
    got = pieces.orderBy("sequence_id", "offset").collect()
    for i, want in ids.items():
        mine = sorted((r["start"], r["ids"]) for r in got if r["doc_id"] == i)
        assert np.frombuffer(b"".join(x for _, x in mine), "<u4").tolist() == want
    at = 0
    for r in got:
        assert (r["sequence_id"], r["offset"]) == divmod(at, 2048) and r["doc_tokens"] == len(ids[r["doc_id"]])
        at += r["length"]
    assert at == sum(map(len, ids.values()))
    whole = packing.sequences(pieces).collect()
    assert all(len(r["ids"]) == 2048 or len(r["ids"]) & (len(r["ids"]) - 1) == 0 for r in whole)
    assert all(r["ids_crc32"] == zlib.crc32(p["ids"]) for r, p in zip(packing.digests(pieces).orderBy("sequence_id", "offset").collect(), got))
    assert packing.pack(docs(spark, []), path).count() == 0


def truth(texts, n, percent=80):
    sets, up = [near_dedup.shingle_set(t or "", n) for t in texts], list(range(len(texts)))

    def root(a):
        while up[a] != a:
            a = up[a]
        return a

    for i, s in enumerate(sets):
        for j in range(i):
            same = len(s & sets[j])
            if s and sets[j] and 100 * same >= percent * (len(s) + len(sets[j]) - same):
                a, b = sorted((root(i), root(j)))
                up[b] = a
    return [root(i) for i in range(len(texts))]


def near_texts():
    rng = random.Random(2)
    vocab = [f"w{i}" for i in range(400)]
    out = list(EDGE)
    for _ in range(12):
        base = [rng.choice(vocab) for _ in range(rng.choice((6, 12, 60, 300)))]
        for _ in range(rng.choice((2, 5, 40))):
            copy = list(base)
            for _ in range(rng.randrange(0, 1 + len(base) // 12)):
                copy[rng.randrange(len(copy))] = rng.choice(vocab)
            out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("words", [2, 5])
def test_near_dedup_brute_force(spark, words):
    texts = near_texts()
    got = near_dedup.mark(docs(spark, texts), words=words, small=4, block=8).collect()
    assert [r["component_id"] for r in sorted(got, key=lambda r: r["doc_id"])] == truth(texts, words)
    assert all(r["kept"] == (r["component_id"] == r["doc_id"]) for r in got)
    assert near_dedup.mark(docs(spark, [])).count() == 0


def test_sketch_estimates():
    g = np.random.default_rng(1)
    for n in (8, 60, 2000):
        errors = []
        for _ in range(40):
            u = np.unique(g.integers(0, 2**64, n, dtype=np.uint64))
            a, b = np.sort(u[: n * 9 // 10]), np.sort(u[n // 10 :])
            s = near_dedup.sketch([a, b])
            j = len(np.intersect1d(a, b)) / len(u)
            errors.append(near_dedup.estimate((s[0] == s[1]).sum(keepdims=True), np.array([len(a)]), np.array([len(b)]))[0] - j)
        assert abs(np.mean(errors)) < 0.03 and not near_dedup.sketch([np.zeros(0, np.uint64)]).any()


def test_windows_of_cartesian_trees():
    g = np.random.default_rng(4)
    values, sizes = g.integers(0, 2**64, 300, dtype=np.uint64), [120, 3, 177]
    starts = np.array([0, 120, 123])
    got = set(zip(*(x.tolist() for x in passages.compact_windows(values, starts, 10))))
    want = set()
    for s, n in zip(starts, sizes):
        for c in range(s, s + n):
            l = r = c
            while l > s and values[l - 1] > values[c]:
                l -= 1
            while r + 1 < s + n and values[r + 1] > values[c]:
                r += 1
            if r - l + 1 >= 10:
                want.add((int(l), int(c), int(r)))
    assert got == want


def test_passages_find_what_repeats(spark):
    rng = random.Random(9)
    vocab = [f"v{i}" for i in range(3000)]
    text = lambda n: [rng.choice(vocab) for _ in range(n)]
    shared = text(55)
    texts = [" ".join(text(100) + shared + text(80)), " ".join(shared + text(150)), " ".join(text(300)), " ".join(text(40) + shared[:40] + text(40)), None, "", "short text"]
    texts += [" ".join(text(rng.randrange(0, 60)) + shared + text(rng.randrange(0, 60))) for _ in range(40)] + [texts[2]]
    got = passages.find(docs(spark, texts), small=4, few=8).collect()
    ids = {r["doc_id"] for r in got} | {r["twin_id"] for r in got}
    assert ids == set(range(len(texts))) - {3, 4, 5, 6}
    first = [r for r in got if r["doc_id"] == 0 and r["twin_id"] == 1]
    assert [(r["start"], r["n_words"], r["twin_start"]) for r in first] == [(100, 55, 0)] and any(r["kind"] == "copy" and (r["doc_id"], r["twin_id"]) == (47, 2) for r in got)
    assert passages.find(docs(spark, [])).count() == 0


def test_near_passages_of_large_groups(spark):
    rng = random.Random(5)
    text = lambda n: [f"v{rng.randrange(10**6)}" for _ in range(n)]
    notice = text(60)

    def changed(i):
        at = 20 + 2 * (i % 10)
        return notice[:at] + [f"z{i}"] + notice[at + 1 :]

    ids, whole = range(90), 41
    bodies = [notice if i == whole else changed(i) for i in ids]
    words = [text(70) + b + text(70) for b in bodies]
    d = docs(spark, [" ".join(w) for w in words])
    sets = [{tuple(b[k : k + 5]) for k in range(56)} for b in bodies]
    assert all(len(sets[whole] & s) >= 0.8 * len(sets[whole] | s) for s in sets)
    for block in (7, 512):
        got = passages.find(d, small=4, few=8, block=block).collect()
        up = {i: i for i in ids}
        for r in got:
            a, b = r["doc_id"], r["twin_id"]
            one, two = (words[x][r[at] : r[at] + r[n]] for x, at, n in ((a, "start", "n_words"), (b, "twin_start", "twin_words")))
            one, two = ({tuple(x[k : k + 5]) for k in range(len(x) - 4)} for x in (one, two))
            assert r["n_words"] >= 50 and len(one & two) >= 0.8 * len(one | two)
            x, y = up[a], up[b]
            up = {i: y if t == x else t for i, t in up.items()}
        assert len(set(up.values())) == 1


@pytest.mark.parametrize("n", [60, 500])
def test_variants_of_a_passage_against_brute_force(spark, n):
    """Default parameters; every text has one or two words of a passage changed, hardly two of them are equal for 50 words."""
    rng = random.Random(n)
    text = lambda k: [f"v{rng.randrange(10**6)}" for _ in range(k)]
    passage, bodies = text(96), []
    for i in range(n):
        b = list(passage)
        for at in rng.sample(range(30, 66), 1 + i % 2):
            b[at] = f"z{i}-{at}"
        bodies.append(b)
    sets = [{tuple(b[k : k + 5]) for k in range(92)} for b in bodies]
    true = {(i, j) for i in range(n) for j in range(i + 1, n) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])}
    got = {(r["doc_id"], r["twin_id"]) for r in passages.find(docs(spark, [" ".join(text(70) + b + text(70)) for b in bodies])).collect()}
    if n <= 60:
        assert len(got & true) >= 0.98 * len(true)

    def roots(pairs):
        up = list(range(n))

        def top(x):
            while up[x] != x:
                x = up[x]
            return x

        for a, b in sorted(pairs):
            a, b = sorted((top(a), top(b)))
            up[b] = a
        return [top(x) for x in range(n)]

    mine = roots(got)
    assert sum(mine[a] == mine[b] for a, b in true) == len(true)


def test_words_repeated_over_and_over(spark):
    texts = ["of " * 70, "a b " + "of " * 52 + "c", "x " + "of " * 30 + "y z", "of " * 28 + "q", "p " + "of " * 49 + "p"]
    got = {(r["doc_id"], r["twin_id"]) for r in passages.find(docs(spark, [*texts, *(f"k{i} " + "of " * 51 for i in range(80))]), small=4, few=8).collect()}
    ids = {x for p in got for x in p}
    assert ids == {0, 1, *range(5, 85)}


def test_passages_beside_lines_that_repeat_inside_a_text(spark):
    rng = random.Random(2)
    text = lambda n: [f"v{rng.randrange(10**6)}" for _ in range(n)]
    texts = []
    for _ in range(12):
        line, more = text(46), text(120)
        texts += [" ".join(line + text(300) + line + more), " ".join(text(60) + line + more[:8] + text(60))]
    got = {(r["doc_id"], r["twin_id"], r["start"], r["n_words"], r["twin_start"]) for r in passages.find(docs(spark, texts)).collect()}
    assert got == {(2 * i, 2 * i + 1, 346, 54, 60) for i in range(12)}


def test_similar_parts_equal_brute_force():
    rng, width = np.random.default_rng(3), 46

    def shingles(words):
        return np.array([hash(tuple(words[i : i + 5])) for i in range(len(words) - 4)], np.int64).view(np.uint64)

    copy = [10**6 + i if (i < 200 and i % 10 == 0) or (i > 200 and i % 48 == 8) else i for i in range(400)]
    cases = [(list(range(400)), copy)]
    for _ in range(40):
        n, gaps, edited = int(rng.integers(80, 160)), rng.choice([6, 12, 30, 60, 90], 4), []
        for i in range(n):
            kind = rng.integers(3) if rng.random() < 1 / gaps[i * 4 // n] else 3
            edited += [[-i - 1], [-i - 1, i], [], [i]][kind]
        cases.append((list(range(n)), edited))
    for one, two in cases:
        a, b = shingles(one), shingles(two)
        at = {h: i for i, h in enumerate(b.tolist())}
        met = [(i, at[h]) for i, h in enumerate(a.tolist()) if h in at]
        best = 0
        for i in range(len(met)):
            for j in range(len(met) - 1, i, -1):
                n, n2, same = met[j][0] - met[i][0] + 1, met[j][1] - met[i][1] + 1, j - i + 1
                if n < max(width, best + 1):
                    break
                if 100 * same >= 80 * (n + n2 - same):
                    best = n
                    break
        got = passages.passages(a, b, (0, len(a) - 1, 0, len(b) - 1), width, 80)
        assert max([e - s + 1 for s, e, *_ in got], default=0) >= best
        for s, e, s2, e2, _ in got:
            x, y = set(a[s : e + 1].tolist()), set(b[s2 : e2 + 1].tolist())
            assert e - s + 1 >= width and 100 * len(x & y) >= 80 * len(x | y)


def test_word_hashes_tell_words_apart():
    texts = [*EDGE, "A b\x0bB  a", "ab", "ba", "a" * 3000, " x"]
    column = pa.array(["skipped", *((t or "") for t in texts)])[1:]
    want = [base.words_of(base.lower_ascii(t or "")) for t in texts]
    for chunk in (1, 64, 1 << 18):
        h, sizes = base.word_hashes(column, chunk)
        assert sizes.tolist() == [len(w) for w in want]
        pairs = set(zip((w for ws in want for w in ws), h.tolist()))
        assert len(pairs) == len({w for w, _ in pairs}) == len({x for _, x in pairs})
    assert len(base.word_hashes(pa.array([], pa.string()))[0]) == 0 and base.word_hashes(pa.array(["", " "]))[1].tolist() == [0, 0]


def test_stretches_that_touch_are_one():
    packed = [l << 28 | r for l, r in ((5, 9), (0, 3), (4, 4), (20, 30), (22, 25), (31, 31), (40, 41))]
    assert passages._merged(packed) == [(0, 9), (20, 31), (40, 41)] and passages._merged([]) == []


def test_coded_places_only_what_is_known():
    known = np.array([2, 5, 9], np.uint64)
    got = passages._coded([np.array([9, 1, 5], np.uint64), np.array([11], np.uint64)], known)
    assert got.tolist() == [[2, 3, 1], [3, 3, 3]]
    assert passages._coded([np.array([4], np.uint64)], known[:0]).tolist() == [[0]]


def test_voted_equals_pair_by_pair():
    rng = np.random.default_rng(4)
    sizes = rng.integers(1, 12, 40)
    l, l2 = rng.integers(0, 60, (2, sizes.sum()))
    rects = np.stack([rng.integers(0, 5, sizes.sum()), l, l + rng.integers(5, 40, len(l)), l2, l2 + rng.integers(5, 40, len(l))], 1)
    got = passages._voted(rects, sizes, 10, 2, most=50)
    for rows, ok in zip(np.split(rects, np.cumsum(sizes)[:-1]), np.split(got, np.cumsum(sizes)[:-1])):
        for (f, a, b, c, d), good in zip(rows, ok):
            votes = {g for g, p, q, r, s in rows if min(b, q) - max(a, p) + 1 >= 10 and min(d, s) - max(c, r) + 1 >= 10}
            assert good == (len(votes) >= 2)


def test_bitmap_never_loses(spark):
    bits = bitmap.build(spark.range(0, 5000, 7))
    assert spark.range(5000).filter(bitmap.maybe(bits, "id")).filter("id % 7 = 0").count() == spark.range(0, 5000, 7).count()


def test_likelihood(spark):
    net = likelihood.WindowNet(3)
    counts = np.random.default_rng(0).integers(0, 5, (likelihood.CLASSES,) * 3)
    _, g = net.gradients(counts)
    for k in ("left", "right", "w", "b", "v", "c"):
        at = tuple(0 for _ in net.p[k].shape)
        net.p[k][at] += 1e-5
        up = net.gradients(counts)[0]
        net.p[k][at] -= 2e-5
        assert abs((up - net.gradients(counts)[0]) / 2e-5 - g[k][at]) < 1e-6
        net.p[k][at] += 1e-5
    losses = net.train(counts, 20)
    assert losses[-1] < losses[0]
    d = docs(spark, [*EDGE, "The cat sat. The cat ran."])
    own, table, by_slot, by_class = likelihood.fit(d)
    got = {r["doc_id"]: r for r in likelihood.score(d, own, table, by_slot, by_class).collect()}
    slot, cls, left, right, _ = likelihood.windows(pa.array(["The cat sat. The cat ran."]), own)
    c = likelihood.CLASSES
    want = sum(float(table[(a * c + b) * c + k]) + by_slot[s] - by_class[k] for s, k, a, b in zip(slot, cls, left, right))
    assert abs(got[11]["log_likelihood"] - want) < 1e-6 and got[0]["n_words"] == 0 and got[0]["mean_log_likelihood"] == 0
    assert left[0] == likelihood.EDGE and right[-1] == likelihood.EDGE and likelihood.score(docs(spark, []), own, table, by_slot, by_class).count() == 0


def test_telephony(spark):
    assert telephony.ULAW_TABLE[[0, 127, 128, 255]].tolist() == [-32124, 0, 32124, 0] and telephony.ALAW_TABLE[[0x55, 0xD5, 0x2A, 0xAA]].tolist() == [-8, 8, -32256, 32256]
    data = np.random.default_rng(1).integers(0, 256, (3, 12), dtype=np.uint8)
    for block, got in zip(data.tolist(), telephony.adpcm_blocks(data).tolist()):
        value, index = int(np.int16(np.uint16(block[0] | block[1] << 8))), min(block[2], 88)
        want = [value]
        for code in [x for b in block[4:] for x in (b & 15, b >> 4)]:
            step = int(telephony.STEPS[index])
            move = (step >> 3) + (step if code & 4 else 0) + (step >> 1 if code & 2 else 0) + (step >> 2 if code & 1 else 0)
            value = max(-32768, min(32767, value - move if code & 8 else value + move))
            index = max(0, min(88, index + int(telephony.MOVES[code])))
            want.append(value)
        assert got == want
    stored = telephony.store_texts(docs(spark, EDGE))
    for r in telephony.describe(telephony.expand(stored)).collect():
        raw = (EDGE[r["doc_id"]] or "").encode()
        full = raw + b" " * (max(192, -(-len(raw) // 192) * 192) - len(raw))
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(full), hashlib.sha256(full).hexdigest(), zlib.crc32(full[-16:]))
    assert telephony.resample(np.array([0, 10], np.int16), 8000, 16000).tolist() == [0, 5, 10, 10] and telephony.expand(stored.limit(0)).count() == 0


def test_chat(spark):
    for text in (r"\### Assistant: </turn> ok", "", r"\.", "a\\", "<turn>### user: x</turn>\n", "#### ", "<</turn>"):
        for role in ("user", "", "a: b</turn>"):
            assert [x[:2] for x in chat.parse(chat.render(role, text))] == [(role, text)]
    with pytest.raises(ValueError):
        chat.parse("<turn>### user: x")
    rows = [(None, None, None, None), (1, 1, "assistant", "b"), (1, 0, "user", "a"), (1, 1, "assistant", "b")]
    got = {r["conv_id"]: r for r in chat.read_back(chat.format_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))).collect()}
    assert got[1]["n_turns"] == 3 and got[1]["loss_chars"] == 2 and got[1]["turns_sha256"] == hashlib.sha256(b"user\na\nassistant\nb\nassistant\nb\n").hexdigest() and got[None]["n_turns"] == 1


def test_quality(spark):
    rng = random.Random(1)
    good = [" ".join(rng.choice("the of and thing other word place".split()) for _ in range(60)) for _ in range(150)]
    bad = [" ".join(rng.choice("THE!! OF!! AND!! THING!!".split()) for _ in range(60)) for _ in range(50)]
    d = docs(spark, [*good, *bad, *EDGE])
    labels = spark.createDataFrame([(i, int(i < 150), 0) for i in range(200)] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    w = quality.fit(d, labels)
    got = {r["doc_id"]: r for r in quality.classify(d, w).collect()}
    assert all(got[i]["__predicted"] == int(i < 150) for i in range(200)) and all(0 <= r["__score"] <= 1 for r in got.values()) and len(got) == 211
    assert abs(got[0]["__score"] - 1 / (1 + np.exp(-(w[-1] + sum(w[i] * v for i, v in zip(*quality.features(good[0]))))))) < 1e-5
    assert set(quality.score(["x"], quality.train([], []))) == {0.5}


def test_loser_tree():
    rng = random.Random(3)
    for k in (0, 1, 2, 5, 8):
        runs = [sorted(((rng.randrange(50),), i) for _ in range(rng.randrange(0, 20))) for i in range(k)]
        assert [x[0] for x in warc.LoserTree(runs)] == sorted(x[0] for r in runs for x in r)


def test_warc_edges(spark):
    page = "p" * 1200
    rows = [(1, "http://B.example.org/a?x#y", page), (2, None, page), (None, "http://a.example.org/", page), (4, "http://a.example.org/ \n", None), (5, "", ""), (6, "u", "small"), (6, "u", "small")]
    d = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = warc.merge_index(warc.read_archives(warc.write_archives(d))).collect()
    assert Counter(r["record_type"] for r in got) == {"response": 5, "revisit": 2} and {r["refers_to"] for r in got if r["record_type"] == "revisit"} == {2}
    assert [r["url_key"] for r in got] == sorted(r["url_key"] for r in got) and all(r["payload_bytes"] == 1200 for r in got if r["record_type"] == "revisit")
    assert warc.merge_index(warc.read_archives(warc.write_archives(d.limit(0)))).count() == 0


def test_mixing(spark):
    for sizes, weights in (([100, 100, 100], [5, 2, 1]), ([1, 1000, 5], [5, 2, 1]), ([0, 10], [5, 2]), ([0], [5])):
        t = mixing.targets(sizes, weights)
        assert abs(sum(t) - sum(sizes)) < 1e-6 and all(x <= 3 * n + 1e-9 for x, n in zip(t, sizes))
    rng = np.random.default_rng(2)
    for _ in range(30):
        sizes = np.unique(rng.integers(1, 40, 6))
        counts = rng.integers(1, 4, len(sizes))
        target = float(rng.uniform(0, 3.2 * np.dot(sizes, counts)))
        reach = {0}
        for s, c in zip(sizes, counts):
            reach = {x + int(s) * k for x in reach for k in range(c + 1)}
        repeats, extra = mixing.fit(sizes, counts, target)
        total = int(np.dot(sizes, counts))
        goal = min(round(target), 3 * total)
        base = min(3, round(target) // total) * total
        got = repeats * total + int(np.dot(sizes, extra))
        assert (extra <= counts).all() and abs(got - goal) == (min(abs(base + x - goal) for x in reach) if base < 3 * total else 0)
    big = mixing.fit(np.arange(1, 2000), np.full(1999, 50), 4e7)
    assert int(np.dot(np.arange(1, 2000), big[1])) == 4 * 10**7
    d = docs(spark, [*EDGE, *["one two three"] * 60], sources=[None] * len(EDGE) + ["a"] * 30 + ["b"] * 30)
    one, two = (sorted(map(tuple, mixing.mix(d).collect()), key=repr) for _ in range(2))
    assert one == two and len(one) == len(EDGE) + 60 and all(r[4] <= 3 * r[1] for r in one)
    assert mixing.apply(d).columns == d.columns and mixing.apply(d).count() == sum(r[5] for r in one) and mixing.mix(docs(spark, [])).count() == 0


def test_pipeline(spark):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "mixing", "packing"]
    d = spark.read.parquet(f"{DIR}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = Counter(r["doc_id"] for r in d.collect())
        d = stage(spark, d, DIR)
        after = Counter(r["doc_id"] for r in d.collect())
        assert d.columns == ["doc_id", "text", "lang", "source", "n_chars"] and set(after) <= set(before)
        assert max(after.values()) <= (3 if name == "mixing" else 1)
    assert corpus_pipeline.run(spark, DIR).count() > 0
