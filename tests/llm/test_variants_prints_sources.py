"""Operators 11 to 13 against plain Python versions, odd rows and empty tables."""

import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from quarry.llm import divergence, simhash, spelling

from . import brute
from .conftest import ODD

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    return {r.doc_id: r.text for r in rows}


# -- operator 11

def words_of(rows):
    found = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = brute.lower(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 7 and n >= 2}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    if len(b) != len(a) + 1:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[at:] == b[at + 1:]


def variants_of(rows):
    words = words_of(rows)
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-words[v], v), default=None)
        if best is not None and words[best] >= 10 * words[w]:
            form[w] = best
    out = {}
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, n, len(near[w]), words.get(form.get(w)))
    return out


def _found(rows):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


def test_variants_of_given_texts(frame, scratch, texts):
    rows = list(texts.items())[:120]
    got = _found(spelling.variants(frame(rows), scratch).collect())
    want = variants_of(rows)
    assert got == want and any(v[3] for v in want.values())


def test_variants_of_dense_words_and_chains(frame, scratch):
    rng = random.Random(1)
    rows, i = [], 0
    for alphabet, size in (("ab", 8), ("abcdé÷Ø", 9), ("aaab", 14)):
        stems = ["".join(rng.choice(alphabet) for _ in range(size)) for _ in range(25)]
        for stem in stems:
            for _ in range(6):
                at = rng.randrange(size)
                word = stem[:at] + rng.choice(["", rng.choice(alphabet), stem[at] + rng.choice(alphabet)]) + stem[at + 1:]
                rows.append((i, " ".join([word] * rng.choice([2, 3, 25, 300]))))
                i += 1
    rows += [(9000, "chainword " * 2500), (9001, "chainwird " * 210), (9002, "chaunwird " * 12)]
    got = _found(spelling.variants(frame(rows), scratch).collect())
    assert got == variants_of(rows)
    assert got["chaunwird"][:2] == ("chainwird", "chainword")


def test_every_near_pair_meets_under_a_key():
    rng = random.Random(2)
    frequency = {a + b: rng.randrange(1, 50) for a in "abc" for b in "abc"}
    rank = {g: i for i, g in enumerate(sorted(frequency, key=lambda g: (frequency[g], g)))}

    def keys(word):
        order = [rank[g] for g in spelling.bigrams(word)]
        prefix, positions = spelling.prefix_positions(order)
        first, second = spelling.pivots(prefix, [frequency[g] for g in spelling.bigrams(word)])
        assert second >= first + 2
        ahead, back, turn = spelling.Spans(word), spelling.Spans(word[::-1]), len(word) - 2
        return (max(order[p] for p in prefix), {*ahead.asked(0, first), *back.asked(2, turn - second)},
                {k for p in positions for k in (*ahead.answers(0, p), *back.answers(2, turn - p))})

    for _ in range(20_000):
        word = "".join(rng.choice(rng.choice(["abc", "aab", "a"])) for _ in range(rng.randrange(7, 12)))
        at = rng.randrange(len(word) + 1)
        other = rng.choice([word[:at] + rng.choice("abc") + word[at:], word[:at] + rng.choice("abc") + word[at + 1:]])
        if word != other and len(other) >= 7:
            x, y = keys(word), keys(other)
            assert (x[0] <= y[0] and x[1] & y[2]) or (y[0] <= x[0] and y[1] & x[2]), (word, other)


def test_pivots_are_the_cheapest_disjoint_choice():
    rng = random.Random(3)
    for _ in range(500):
        weight = [rng.randrange(20) for _ in range(12)]
        positions = sorted(rng.sample(range(12), rng.randrange(3, 9)))
        for edits in (1, 2):
            fits = [c for c in itertools.combinations(positions, edits + 1)
                    if all(q >= p + 2 for p, q in zip(c, c[1:]))]
            if fits:
                got = spelling.pivots(positions, weight, edits)
                assert tuple(got) in fits
                assert sum(weight[p] for p in got) == min(sum(weight[p] for p in c) for c in fits)


def test_checksums_equal_the_library():
    data = np.frombuffer("abcéxyz".encode() * 40, np.uint8)
    starts, ends = np.array([0, 3, 10, 5]), np.array([0, 9, 200, 69])
    state = np.array([zlib.crc32(b"7:"), zlib.crc32(b":"), zlib.crc32(b"1:"), 0], np.uint32)
    want = [zlib.crc32(data[a:b].tobytes(), int(s)) for a, b, s in zip(starts, ends, state)]
    assert spelling.checksums(data, state, starts, ends).tolist() == want


def test_variants_of_odd_rows(spark, frame, scratch):
    rows = [*ODD, (10, "y" * 50_000), (11, "x" * 49_999 + " " + "x" * 49_999), (12, "x" * 50_000)]
    got = _found(spelling.variants(frame(rows), scratch).collect())
    assert got == variants_of(rows)
    assert spelling.variants(frame([(1, "a")]).filter("false"), scratch).count() == 0
    assert spelling.variants(frame([(1, "short words only"), (2, None)]), scratch).count() == 0


# -- operator 12

def print_of(text):
    words = brute.WORD.findall(brute.lower(text or ""))
    runs = [" ".join(words[i:i + 4]) for i in range(max(len(words) - 3, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(prints, bits=4):
    """position -> smallest position reachable."""
    parent = list(range(len(prints)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(prints)), 2):
        if (prints[a] ^ prints[b]).bit_count() <= bits:
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    return [root(i) for i in range(len(prints))]


def prints_of(rows):
    prints = [print_of(t) for _, t in rows]
    groups = defaultdict(list)
    for (i, _), root in zip(rows, of := linked(prints)):
        groups[root].append(i)
    least = {r: min((i for i in g if i is not None), default=None) for r, g in groups.items()}
    return sorted(((i, f"{p:016x}", least[r]) for (i, _), p, r in zip(rows, prints, of)), key=repr)


def _same(out, rows):
    assert sorted(map(tuple, out.collect()), key=repr) == prints_of(rows)


def test_prints_of_given_texts(frame, scratch, texts):
    rows = list(texts.items())
    _same(simhash.near_duplicates(frame(rows), scratch), rows)


def test_prints_of_near_copies_and_odd_rows(frame, scratch, monkeypatch):
    rng = random.Random(4)
    rows = list(ODD)
    for g in range(6):
        words = [f"w{rng.randrange(300)}" for _ in range(60 + 40 * g)]
        for k in range(25):
            words[rng.randrange(len(words))] = f"n{rng.randrange(99)}"
            rows.append((100 * g + 50 + k, " ".join(words)))
    _same(simhash.near_duplicates(frame(rows), scratch), rows)
    monkeypatch.setattr(simhash.links, "__defaults__", (4, 5))
    _same(simhash.near_duplicates(frame(rows), scratch), rows)
    assert simhash.near_duplicates(frame(ODD).filter("false"), scratch).count() == 0


def _nodes(spark, prints):
    return spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "node bigint")


def test_prints_within_four_bits_share_a_variant(spark):
    rng = random.Random(5)
    prints = [rng.getrandbits(64) for _ in range(40)]
    other = [p ^ sum(1 << b for b in rng.sample(range(64), 4)) for p in prints]
    keys = defaultdict(set)
    for r in simhash.variants(_nodes(spark, prints + other)).collect():
        keys[r.node % (1 << 64)].add(r.key)
    assert all(keys[a] & keys[b] for a, b in zip(prints, other))
    assert all(len(k) == 64 for k in keys.values())


def test_links_of_a_large_block_stay_few(spark):
    """A block's links form a forest: fewer than its nodes, however many pairs are near."""
    rng = random.Random(6)
    made = {}
    for n in (300, 600):
        prints = list({sum(1 << b for b in rng.sample(range(30, 50), 3)) for _ in range(n)})
        nodes = _nodes(spark, prints).selectExpr("CAST(7 AS BIGINT) AS key", "node")
        for chunk, most in ((4096, 1), (50, 2 * len(prints) // 50 + 2)):
            found = [(r.a % (1 << 64), r.b % (1 << 64)) for r in simhash.links(nodes, 4, chunk).collect()]
            assert all((a ^ b).bit_count() <= 4 for a, b in found)
            assert len(found) < most * len(prints)
            pairs = dict.fromkeys(prints)
            at = {p: i for i, p in enumerate(pairs)}
            parent = list(range(len(prints)))

            def root(x):
                while parent[x] != x:
                    x = parent[x]
                return x

            for a, b in found:
                low, high = sorted((root(at[a]), root(at[b])))
                parent[high] = low
            assert [root(i) for i in range(len(prints))] == linked(prints)
            if chunk == 4096:
                assert len(found) == len(prints) - len(set(linked(prints)))
                made[n] = len(found)
    assert made[600] <= 2.2 * made[300]


def test_blocks_over_the_edge_of_a_batch_stay_whole():
    import pyarrow as pa
    rng = random.Random(8)
    key = np.sort(np.array([rng.randrange(60) for _ in range(900)] + [60] * 400, np.int64))
    node = np.array([rng.getrandbits(5) << 20 | rng.getrandbits(3) << 40 for _ in key], np.int64)
    zero = np.zeros(len(key), np.int64)
    batch = pa.RecordBatch.from_arrays([pa.array(x) for x in (key, zero, zero, node)],
                                       names=["key", "first", "second", "node"])
    whole = simhash.block_links(1)
    held, simhash.HELD_ROWS = simhash.HELD_ROWS, 100
    try:
        cut = [r for b in whole(iter([batch.slice(i, 37) for i in range(0, len(key), 37)])) for r in b.to_pylist()]
    finally:
        simhash.HELD_ROWS = held
    once = [r for b in whole(iter([batch])) for r in b.to_pylist()]
    assert sorted(map(repr, cut)) == sorted(map(repr, once)) and once


def test_too_many_bits_for_the_segments_are_refused(frame, scratch):
    with pytest.raises(ValueError):
        simhash.near_duplicates(frame(ODD), scratch, bits=6)


# -- operator 13

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def audit_of(rows):
    """rows: (lang, source, text)."""
    docs, counts, groups = defaultdict(Counter), defaultdict(Counter), set()
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        terms = TERM.findall(brute.lower(text or ""))
        groups.add((lang, source))
        docs[lang].update(set(terms))
        counts[lang, source].update(terms)
        counts[lang].update(terms)
    out = []
    shares = {}
    for g in [*groups, *{x for x, _ in groups}]:
        lang = g if isinstance(g, str) else g[0]
        kept = [t for t, n in docs[lang].items() if n >= 3]
        total = sum(counts[g][t] for t in kept)
        shares[g] = {t: 1 + 10 ** 9 * (counts[g][t] + 1) // (total + len(kept)) for t in kept}
    gap = lambda p, q: (p - q) * (p - q) // q
    for lang, source in groups:
        mine = shares[lang, source]
        pairs = [(o, sum(gap(mine[t], shares[lang, o][t]) for t in mine)) for x, o in groups
                 if x == lang and o != source]
        terms = [(t, gap(p, shares[lang][t])) for t, p in mine.items()
                 if counts[lang, source][t] and p > shares[lang][t]]
        for part, found in (("pair", pairs), ("term", terms)):
            found.sort(key=lambda f: (-f[1], f[0].encode()))
            out += [(lang, source, part, item, value, k + 1) for k, (item, value) in enumerate(found)
                    if part == "pair" or k < 200]
    return sorted(out)


def _audit(spark, scratch, rows, **more):
    docs = spark.createDataFrame([(*r, "x", 1, 2) for r in rows],
                                 "lang string, source string, text string, term string, n int, rank int")
    return sorted(map(tuple, divergence.audit(docs, scratch, **more).collect()))


def test_audit_of_given_texts(spark, scratch):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet")
            .select("lang", "source", "text").collect()]
    assert _audit(spark, scratch, rows) == audit_of(rows)


def test_audit_of_odd_rows(spark, scratch):
    long = "x" * 40_000
    rows = [("en", f"s{k % 3}", t) for k, (_, t) in enumerate(ODD)]
    rows += [(None, "a", "word word"), ("", None, "word"), (None, None, None), ("", "b", "word Other"),
             ("fr", "only", "seul " * 5), ("de", "a", "1 2 3"), ("de", "b", ""),
             ("en", "s0", long), ("en", "s1", long), ("en", "s1", long + "y"), ("en", "s2", long + " " + long), ("en", "s9", long),
             *[("en", f"s{k}", "filler") for k in range(3)],
             ("es", "a", "niño ÑU año año"), ("es", "b", "niño Ñu ano"), ("es", "c", "niño Ñu\U00010400"),
             ("es", "c", "niño Ñu\U00010400"), ("es", "c", "niñ \U00010400"), ("es", "d", "")]
    got = _audit(spark, scratch, rows)
    assert got == audit_of(rows)
    assert any(len(r[3]) == 40_000 for r in got)
    assert [r[4] for r in got if r[:3] == ("de", "a", "pair")] == [0]
    assert divergence.audit(spark.createDataFrame([], "lang string, source string, text string"),
                            scratch).count() == 0


def test_levels_discard_rare_prefixes_and_full_bitmaps_lose_nothing(spark, scratch):
    rng = random.Random(7)
    rows = [("en", f"s{rng.randrange(3)}", " ".join(
        "".join(rng.choice("abcde") for _ in range(rng.choice([2, 5, 9, 20]))) for _ in range(30)) +
        " commonterm commonterminal") for _ in range(60)]
    docs = spark.createDataFrame(rows, "lang string, source string, text string")
    first = divergence.level(docs, 0, 4, None, 1 << 15)
    short = {(r.prefix.decode() if isinstance(r.prefix, (bytes, bytearray)) else r.prefix): r.all_docs
             for r in first.filter("not whole").collect() if r.lead}
    want = Counter(p for _, _, t in rows for p in {w[:4] for w in t.split() if len(w) > 4})
    assert short == dict(want)
    kept = spark.sparkContext.broadcast(divergence.kept_bitmap(first.filter("not whole and all_docs >= 3"), 1 << 15))
    second = {bytes(r.prefix) for r in divergence.level(docs, 4, 8, kept, 1 << 15).collect()}
    alive = {p for p, n in want.items() if n >= 3}
    words = {w for _, _, t in rows for w in t.split() if len(w) > 4}
    assert {w[:8].encode() for w in words if w[:4] in alive} <= second
    assert len(second) < len({w[:8] for w in words})  # rare prefixes are not extended
    assert _audit(spark, scratch, rows, slots=8) == audit_of(rows)
