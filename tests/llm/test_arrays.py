"""Operators with array kernels against brute force."""

import hashlib
import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import DATA
from quarry.llm import components, cotraining, decontaminate, ngram_join, passages, substring
from quarry.llm.suffixes import common_prefixes, suffix_array
from quarry.llm.tables import table

DOCS = "doc_id long, text string, lang string, source string, n_chars long, block int, n long, key string"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, None, None, None, 1, 2, "k") for i, t in rows], DOCS)


def words(rnd, n, size=400):
    return " ".join(f"w{rnd.randrange(size)}" for _ in range(n))


def ascii_lower(s):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in s)


@pytest.mark.parametrize("letters", [1, 2, 4, 256])
def test_two_stage_sorting(letters):
    rnd = random.Random(letters)
    for _ in range(40):
        raw = bytes(rnd.randrange(letters) for _ in range(rnd.randint(1, 200))) * rnd.choice([1, 2])
        text, wanted = np.frombuffer(raw, np.uint8), np.array([rnd.random() < 0.7 for _ in raw])
        got = suffix_array(text, wanted, 50)
        assert sorted(got) == list(np.flatnonzero(wanted))
        whole = np.array([i for i in got if i + 58 <= len(raw)], dtype=np.int64)
        keys = [raw[i : i + 50] for i in whole]
        assert keys == sorted(keys)
        for k, n in enumerate(common_prefixes(text, whole, 50)[1:], 1):
            assert keys[k - 1][:n] == keys[k][:n] and (n == 50 or keys[k - 1][n] != keys[k][n])


def brute_substrings(rows):
    seen, out = {}, {}
    for i, t in sorted((i, (t or "").encode()) for i, t in rows):
        gone = bytearray(len(t))
        for k in range(len(t) - 49):
            if seen.setdefault(t[k : k + 50], i) < i:
                gone[k : k + 50] = b"\1" * 50
        kept = bytes(c for c, g in zip(t, gone) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1]))
        out[i] = (len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("hot", [1, 3, 5000])
def test_substrings(spark, hot):
    rnd = random.Random(3)
    shared = [words(rnd, 40) for _ in range(4)] + ["é" * 60, "aaaa" * 40]
    rows = [(i, None if i % 11 == 5 else words(rnd, rnd.randint(0, 60)) + rnd.choice(shared) + words(rnd, 8)) for i in range(90)]
    rows += [(90, ""), (91, "x" * 49), (92, "x" * 49), (93, "y" * 50), (94, "y" * 50), (95, "z" * 500), (96, rows[1][1])]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in substring.deduplicated(docs(spark, rows), hot).collect()}
    assert got == brute_substrings(rows)
    assert got[94][1] == 50 and got[92][1] == 0 and got[95][1] == 0  # repeats within one document stay


def test_rows_without_doc_id_stay(spark):
    text = "one two three four five six seven eight nine ten eleven twelve"
    rows = docs(spark, [(None, text), (4, text), (5, text)])
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans) for r in substring.deduplicated(rows).collect()}
    assert got == {None: (len(text), 0, 0), 4: (len(text), 0, 0), 5: (len(text), len(text), 1)}
    assert sorted((str(r.doc_id), r.component_id) for r in ngram_join.joined(rows).collect()) == [("4", 4), ("5", 4), ("None", 4)]


def test_anchors_are_weighed_by_their_text():
    keys, doc = np.array([7, 7, 9], np.uint64), np.array([0, 0, 1])
    k, d = substring.weighed(keys, doc, np.array([substring.UNIT, substring.UNIT, 5]), 2)
    assert k.tolist() == [7, 7, 9, 7] and len({x for x, y in zip(d.tolist(), k.tolist()) if y == 7}) == 2
    _, texts, _, counts = substring.segments([b"=" * 20_000])
    assert counts.sum() == 20_000 - substring.LENGTH + 1 and counts.max() <= substring.PIECE and set(texts.tolist()) == {0}


def test_passages_lie_where_tokens_are_shared():
    shared = np.zeros(400, dtype=bool)
    shared[100:120] = True  # too short for a passage
    shared[200:260] = True
    start, stop = passages.sections(shared, np.repeat([0, 1], 200))
    assert len(start) == 1 and start[0] >= 200 and 246 <= stop[0] <= 280


def test_substrings_of_nothing_and_of_repeated_rows(spark):
    assert substring.deduplicated(docs(spark, [])).count() == 0
    assert [r.n_removed for r in substring.deduplicated(docs(spark, [(1, "q" * 80), (1, "q" * 80)])).collect()] == [0, 0]


@pytest.mark.parametrize("n", [20, 2_000, 60_000])
def test_shift_tables_grow_with_their_patterns(n):
    rnd = random.Random(n)
    patterns = ["".join(rnd.choices("abcdefghijklmnopqrstuvwxyz ", k=70)).encode() for _ in range(n)]
    band = decontaminate.Band(patterns)
    text = np.frombuffer("".join(rnd.choices("abcdefghijklmnopqrstuvwxyz ", k=200_000)).encode(), np.uint8)
    moves = band.shift[band.slot(decontaminate.block_words(text, band.block))]
    assert moves.mean() > 0.6 * (band.least - band.block + 1)  # most places are skipped, however many patterns there are
    planted = text.copy()
    for k, at in enumerate(range(50, 150_000, 9_000)):
        planted[at : at + 70] = np.frombuffer(patterns[k % n], np.uint8)
    found = {(int(s), int(p)) for starts, which in band.search(planted) for s, p in zip(starts, which)}
    assert found == {(at, k % n) for k, at in enumerate(range(50, 150_000, 9_000))}


def brute_contamination(rows, items):
    split = lambda s: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(s or ""))
    windows = {}
    for i, t in items:
        w = split(t)
        for k in range(max(1, len(w) - 12) if w else 0):
            windows.setdefault(tuple(w[k : k + 13]), set()).add(str(i))
    out = {}
    for i, t in rows:
        w, found = split(t), set()
        hit = [0] * len(w)
        for size in {len(x) for x in windows}:
            for k in range(len(w) - size + 1):
                if own := windows.get(tuple(w[k : k + size])):
                    found |= own
                    hit[k : k + size] = [1] * size
        n = sum(hit)
        out[i] = (len(w), n, len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), n > 0 and 20 * n >= len(w))
    return out


@pytest.mark.parametrize("limit", [decontaminate.PATTERN_BYTES, 200])
def test_decontamination(spark, limit, monkeypatch):
    monkeypatch.setattr(decontaminate.pattern_blocks, "__defaults__", (limit,))
    rnd = random.Random(5)
    items = [(1, words(rnd, 30)), (2, "Short, Item!"), (3, "é"), (4, None), (5, "..."), (6, words(rnd, 13)), (7, "Short item"), (10, words(rnd, 12))]
    rows = [(i, words(rnd, rnd.randint(0, 80)) + "; " + (rnd.choice(items)[1] or "").upper() + " " + words(rnd, rnd.randint(0, 9))) for i in range(60)]
    rows += [(60, None), (61, ""), (62, "short\titem short item"), (63, "É é"), (64, " ".join(items[0][1].split()[3:20])), (65, "shortitem"), (66, words(rnd, 30000) + " " + items[5][1])]
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in decontaminate.contaminated(docs(spark, rows), bench).collect()}
    assert got == brute_contamination(rows, items)
    assert decontaminate.contaminated(docs(spark, []), bench).count() == 0
    none = decontaminate.contaminated(docs(spark, rows[:3]), bench.limit(0)).collect()
    assert len(none) == 3 and not any(r.contaminated for r in none)


def test_benchmark_blocks_are_bounded_and_items_may_lack_an_id(spark):
    rnd = random.Random(6)
    bench = spark.createDataFrame([(None, "one two three"), (3, words(rnd, 400)), (4, "one two three")], "item_id long, text string")
    blocks = list(decontaminate.pattern_blocks(bench, 13, 500))
    longest = max(len(p) for block, _ in blocks for p in block)
    assert len(blocks) > 3 and all(sum(map(len, block)) <= 500 + longest for block, _ in blocks)
    got = decontaminate.contaminated(docs(spark, [(1, "one two three four")]), bench).first()
    assert (got.n_hit, got.n_items, got.items_sha256) == (3, 1, hashlib.sha256(b"4").hexdigest())
    only = decontaminate.contaminated(docs(spark, [(1, "one two three four")]), bench.filter("item_id is null")).first()
    assert (only.n_hit, only.n_items, only.contaminated) == (3, 0, True)


def brute_groups(rows):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(t or ""))
        sets[i] = frozenset([tuple(w)] if 0 < len(w) < 5 else [tuple(w[k : k + 5]) for k in range(len(w) - 4)])
    up = {i: i for i in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            a, b = sets[i], sets[j]
            common = len(a & b)
            if a and b and 100 * common >= 75 * (len(a) + len(b) - common):
                x, y = root(i), root(j)
                up[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in ids}


def near_copies(seed):
    rnd = random.Random(seed)
    rows = [(0, None), (1, ""), (2, " \n"), (3, "One"), (4, "one"), (5, "a b c d"), (6, "a b c d e"), (7, "A  b\tc d E")]
    bases = [words(rnd, n).split() for n in (6, 7, 8, 9, 12, 17, 25, 40, 41, 80, 150, 300)]
    for base in bases:
        for _ in range(14):
            w = list(base)
            for _ in range(rnd.randint(0, 1 + len(w) // 25)):
                k = rnd.randrange(len(w))
                w[k : k + 1] = rnd.choice([[f"n{rnd.randrange(99)}"], [], [w[k], "plus"]])
            w += words(rnd, rnd.choice([0, 0, len(w) // 4])).split()
            rows.append((len(rows), " ".join(w)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_groups_lose_no_link(spark, seed):
    rows = near_copies(seed)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.joined(docs(spark, rows)).collect()}
    assert got == brute_groups(rows)
    assert max(Counter(c for _, c in got.values()).values()) > 5


def test_groups_of_nothing_and_of_repeated_rows(spark):
    assert ngram_join.joined(docs(spark, [])).count() == 0
    assert [(r.doc_id, r.component_id) for r in ngram_join.joined(docs(spark, [(9, "a b c d e f"), (9, "a b c d e f")])).collect()] == [(9, 9)] * 2


def test_components(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(1, 60)] + [(100, 90), (90, 95)], "a long, b long")
    got = {r.node: r.component for r in components.components(links).collect()}
    assert set(got[k] for k in range(1, 61)) == {1} and got[100] == got[95] == 90
    assert components.components(links.limit(0)).count() == 0


def test_passages_are_found_and_verified(spark):
    rnd = random.Random(11)
    base = [words(rnd, 70, 5000) for _ in range(12)]
    rows, planted = [], set()
    for k, p in enumerate(base):
        w = p.split()
        rows.append((2 * k, words(rnd, 90, 9000) + " " + p + " " + words(rnd, 40, 9000)))
        if k % 2:
            w[35] = "changed"
        rows.append((2 * k + 1, words(rnd, 30, 9000) + " " + " ".join(w) + " " + words(rnd, 70, 9000)))
        planted.add((2 * k + 1, 2 * k))
    rows += [(100 + k, words(rnd, 200, 9000)) for k in range(10)] + [(200, None), (201, ""), (202, "one two")]
    got = passages.near_passages(docs(spark, rows)).collect()
    text = dict(rows)
    cut = lambda i, s, n: [tuple(w) for w in [text[i].lower().split()[s : s + n]] for w in zip(*(w[k:] for k in range(5)))]
    for r in got:
        a, b = set(cut(r.doc_id, r.start, r.n_words)), set(cut(r.other_id, r.other_start, r.other_n_words))
        assert r.n_words >= 50 and r.other_n_words >= 50
        assert abs(len(a & b) / len(a | b) - r.similarity) < 1e-9 and r.similarity >= 0.75
    pairs = {(r.doc_id, r.other_id) for r in got}
    assert pairs <= planted and len(pairs) >= 11
    assert passages.near_passages(docs(spark, [])).count() == 0


def linked_passages(spark, rows):
    return {(r.doc_id, r.other_id) for r in passages.near_passages(docs(spark, rows)).collect()}


def changed(rnd, p, n):
    q = list(p)
    for _ in range(n):
        i = rnd.randrange(len(q))
        q[i : i + rnd.randrange(2)] = [f"other{rnd.randrange(99999)}"] * rnd.randrange(2)  # replaced, put in, left out, or as it was
    return q


def test_recall_of_near_passages_by_length_and_place_of_change(spark):
    rnd = random.Random(9)
    new = lambda n: [f"w{rnd.randrange(90000)}" for _ in range(n)]
    grams = lambda w: {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
    rows, kind = [], {}

    def plant(name, p, q):
        a, b = grams(p), grams(q)
        if min(len(p), len(q)) >= 50 and len(a & b) >= 0.75 * len(a | b):
            kind[len(rows) + 1, len(rows)] = name
            rows.extend([(len(rows), " ".join(new(40) + p + new(30))), (len(rows) + 1, " ".join(new(25) + q + new(60)))])

    for at in [*range(50)] * 2:
        p = new(50)
        plant(f"50 words, word {at // 10 * 10}", p, p[:at] + ["other"] + p[at + 1 :])
    for n in (50, 60, 100, 300):
        for changes in (1, 2, 3):
            for _ in range(25):
                p = new(n)
                plant(f"{n} words, {changes} changes", p, changed(rnd, p, changes))
    got = linked_passages(spark, rows)
    assert got <= set(kind)
    planted, found = Counter(kind.values()), Counter(kind[x] for x in got)
    assert len(planted) >= 15 and all(found[k] >= 0.9 * n for k, n in planted.items())


def test_passages_meet_every_earlier_holder(spark):
    rnd = random.Random(21)
    rows, wanted = [], set()
    for k in range(8):  # six holders of halves too short for a passage come before the two that share the whole
        halves = words(rnd, 40, 90000), words(rnd, 40, 90000)
        rows += [(10 * k + j, words(rnd, 60, 90000) + " " + halves[j % 2] + " " + words(rnd, 60, 90000)) for j in range(6)]
        rows += [(10 * k + j, words(rnd, 60, 90000) + " " + " ".join(halves) + " " + words(rnd, 60, 90000)) for j in (6, 7)]
        wanted.add((10 * k + 7, 10 * k + 6))
    got = linked_passages(spark, rows)
    assert got <= wanted and len(got) >= 7


def test_passages_after_an_earlier_copy_in_the_document(spark):
    rnd = random.Random(22)
    rows = []
    for k in range(8):
        p = words(rnd, 70, 90000)
        rows.append((2 * k, words(rnd, 60, 90000) + " " + p))
        rows.append((2 * k + 1, p + " " + words(rnd, 200, 90000) + " " + p))
    got = passages.near_passages(docs(spark, rows)).collect()
    both = Counter(r.doc_id for r in got if r.start < 60) & Counter(r.doc_id for r in got if r.start > 200)
    assert len(both) >= 7


def test_every_two_documents_with_near_copies_are_linked(spark):
    rnd = random.Random(41)
    rows, wanted = [], set()

    def link(group):
        wanted.update((i, j) for i in group for j in group if i > j)

    for k in range(5):  # near copies of one passage, each changed at another place: all of them are pairs
        p = words(rnd, 120, 90000).split()
        for j in range(4):
            q = p[: 25 * j + 10] + [f"other{k}x{j}"] + p[25 * j + 11 :]
            rows.append((100 * k + j, words(rnd, 50, 90000) + " " + " ".join(q) + " " + words(rnd, 40, 90000)))
        link(range(100 * k, 100 * k + 4))
    for k in range(5):  # an earlier passage overlaps the one that another document has
        p = words(rnd, 90, 90000).split()
        rows.append((1000 + 10 * k, words(rnd, 50, 90000) + " " + " ".join(p[:60])))
        rows.append((1001 + 10 * k, words(rnd, 50, 90000) + " " + " ".join(p[30:])))
        rows.append((1002 + 10 * k, " ".join(p) + " " + words(rnd, 40, 90000)))
        wanted.update({(1002 + 10 * k, 1000 + 10 * k), (1002 + 10 * k, 1001 + 10 * k)})
    assert linked_passages(spark, rows) == wanted


def test_word_for_word_copies_are_linked_to_the_first_and_near_ones_to_it(spark):
    rnd = random.Random(42)
    p = words(rnd, 80, 90000).split()
    near = p[:40] + ["other"] + p[41:]
    rows = [(k, words(rnd, 50, 90000) + " " + " ".join(p) + " " + words(rnd, 50, 90000)) for k in range(30)]
    rows += [(30 + k, words(rnd, 50, 90000) + " " + " ".join(near) + " " + words(rnd, 50, 90000)) for k in range(30)]
    got = passages.near_passages(docs(spark, rows)).collect()
    same = {(r.doc_id, r.other_id) for r in got if r.similarity == 1}
    assert same == {(k, 0) for k in range(1, 30)} | {(30 + k, 30) for k in range(1, 30)}  # members and their first
    assert {(r.doc_id, r.other_id) for r in got if r.similarity < 1} == {(30, 0)}  # the firsts of both
    assert all((r.start, r.n_words, r.other_start) == (50, 80, 50) for r in got if r.similarity == 1)


def test_passages_do_not_depend_on_cells_and_turns(spark, monkeypatch):
    rng = random.Random(5)
    base = [f"w{k}" for k in range(120)]
    rows = []
    for i in range(24):
        own = list(base)
        for _ in range(3):
            own[rng.randrange(120)] = f"x{i}_{rng.randrange(99)}"
        rows.append((i, " ".join([f"a{i}_{k}" for k in range(30)] + own)))
    calls, plain = [], passages.saved
    monkeypatch.setattr(passages, "saved", lambda df, label: calls.append(label) or plain(df, label))
    few = sorted(passages.near_passages(docs(spark, rows)).collect())
    assert calls.count("passages") == 2  # one turn, and the copies
    monkeypatch.setattr(passages, "CELL_PAIRS", 5)
    monkeypatch.setattr(passages, "TURN_BYTES", 1)
    calls.clear()
    many = sorted(passages.near_passages(docs(spark, rows)).collect())
    assert calls.count("passages") > 3
    assert few == many and len({(r.doc_id, r.other_id) for r in few}) > 200


def test_candidates_are_judged_alike_alone_and_together():
    rng = np.random.default_rng(8)
    xs, ys = [], []
    for n in range(60):
        x = rng.integers(0, [30, 4000][n % 2], rng.integers(1, 300)).astype(np.uint32)
        y = np.concatenate([rng.integers(0, 4000, rng.integers(1, 40)).astype(np.uint32), x])
        y[rng.random(len(y)) < 0.1] = 9999
        xs.append(x), ys.append(y)
    together = sorted(zip(*(v.tolist() for v in passages.judged(xs, ys))))
    alone = sorted((n, *r[1:]) for n in range(60) for r in zip(*(v.tolist() for v in passages.judged(xs[n : n + 1], ys[n : n + 1]))))
    assert together == alone and len(together) > 20
    for n, s, e, s2, e2, share in together:
        u, v = set(xs[n][s:e].tolist()), set(ys[n][s2:e2].tolist())
        assert share == len(u & v) / len(u | v) >= passages.SIMILARITY and min(e - s, e2 - s2) >= passages.LEAST


def test_passages_of_runs(spark):
    rows = [(k, words(random.Random(k), 60, 9000) + " same" * (3000 + k)) for k in range(3)]
    assert {(1, 0), (2, 0)} <= linked_passages(spark, rows)


def test_passages_end_at_a_long_unshared_middle(spark):
    rnd = random.Random(23)
    rows = []
    for k in range(8):
        head, tail = words(rnd, 400, 90000), words(rnd, 400, 90000)
        rows += [(2 * k + j, f"{head} {words(rnd, 250, 90000)} {tail}") for j in (0, 1)]
    text = {i: t.split() for i, t in rows}
    shingles = lambda i, s, n: {tuple(text[i][k : k + 5]) for k in range(s, s + n - 4)}
    got = passages.near_passages(docs(spark, rows)).collect()
    for r in got:
        a, b = shingles(r.doc_id, r.start, r.n_words), shingles(r.other_id, r.other_start, r.other_n_words)
        assert abs(len(a & b) / len(a | b) - r.similarity) < 1e-9 and r.similarity >= 0.75
        assert r.start + r.n_words <= 400 or r.start >= 650
    assert len({(r.doc_id, r.start < 400) for r in got}) >= 14


def test_cartesian_windows():
    rnd = random.Random(2)
    value = np.array([rnd.randrange(40) for _ in range(120)], dtype=np.uint64)
    doc = np.repeat([0, 1], 60)
    got = {int(m): (int(a), int(b)) for m, a, b in zip(*passages.compact_windows(value, passages.Frame(doc, 7)))}
    for lo in range(0, 120):
        for hi in range(lo + 7, 121):
            if doc[lo] == doc[hi - 1]:
                low = value[lo:hi].min()
                assert any(value[m] == low and lo <= m < hi for m in got)
    for m, (a, b) in got.items():
        assert doc[a] == doc[b] == doc[m] and value[a : b + 1].min() == value[m]


def test_classifier_on_labels_it_has_not_seen(spark):
    sf = DATA.replace("sf0.001", "sf0.1")
    labels = table(spark, sf, "labels")
    seen = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    scored = cotraining.classified(table(spark, sf, "documents"), labels.filter(seen))
    unseen = scored.join(labels.filter(~seen), "doc_id").toPandas()
    good = (unseen.quality == 1) & (unseen.toxic == 0)
    assert len(unseen) > 1500 and unseen.kept[good].mean() > 0.97 and unseen.kept[~good].mean() < 0.35


def test_classifier_learns_the_same_whatever_the_order_of_repeated_rows(spark):
    rnd = random.Random(12)
    rows = [(k % 60, " ".join(rnd.choices(["fine", "words", "here"] if k % 2 else ["BUY!", "NOW!", "$$$"], k=20))) for k in range(180)]
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(60)], "doc_id long, quality int, toxic int")
    parts = [cotraining.sample(docs(spark, r).repartition(n), labels, 100) for r, n in ((rows, 1), (rows[::-1], 5))]
    assert (parts[0][0].feature == parts[1][0].feature).all() and (parts[0][1].rows == parts[1][1].rows).all()


def test_classifier_on_its_own_labels(spark):
    sf = DATA.replace("sf0.001", "sf0.01")
    scored = cotraining.classified(table(spark, sf, "documents"), table(spark, sf, "labels")).toPandas()
    truth = table(spark, sf, "labels").toPandas()
    both = scored.merge(truth, on="doc_id")
    good = (both.quality == 1) & (both.toxic == 0)
    assert len(scored) == 1000 and both.kept[good].mean() > 0.97 and both.kept[~good].mean() < 0.35


def test_every_unlabelled_document_takes_part(spark):
    rnd = random.Random(31)
    good = [f"good{k}" for k in range(20)]
    bad = [f"BAD!{k}" for k in range(20)]
    n = 3400  # more than were sampled once
    rows = [(k, " ".join(rnd.choices(good if k % 2 else bad, k=30))) for k in range(n + 200)]
    # labels only of the first 200
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(200)], "doc_id long, quality int, toxic int")
    df = docs(spark, rows).withColumn("source", F.when(F.col("doc_id") % 2 == 1, "a").otherwise("b"))
    text, meta, label, others = cotraining.sample(df, labels, cotraining.LABELLED)
    assert len(label) == 200 and others.count() == n
    y, weight = (label == 1).astype(float), np.ones(200)
    views = [cotraining.fit(x, y, weight) for x in (text, meta)]
    sure = 0.8
    pools = cotraining.pooled(others, [views], views, sure)
    assert [p.n for p in pools] == [n, n]
    # the sums are those of the rows taken together
    got = others.collect()
    x = cotraining.Sparse([np.frombuffer(r.text, np.int32) for r in got])
    wanted = np.array([r.doc_id % 2 for r in got])
    slope = x.back(cotraining.sigmoid(x.times(views[0].weights) + views[0].bias) - wanted)
    assert np.allclose(pools[0].slope[:-1], slope)
    assert np.abs(cotraining.fit(text, y, weight, pools[0]).weights - views[0].weights).max() > 0


def test_classifier_without_labels_and_with_nulls(spark):
    df = docs(spark, [(1, None), (2, ""), (3, "a"), (3, "a")])
    labels = spark.createDataFrame([(7, 1, None), (None, 0, 0), (1, None, 1)], "doc_id long, quality int, toxic int")
    assert [r.kept for r in cotraining.classified(df, labels).collect()] == [True] * 4
    assert cotraining.classified(df.limit(0), labels).count() == 0


def test_pipeline_stages(spark):
    import corpus_pipeline

    df = table(spark, DATA, "documents")
    columns = df.columns
    before = df
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        after = stage(spark, before, DATA)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert after.columns == columns
            ids = {r.doc_id for r in after.select("doc_id").collect()}
            assert ids <= {r.doc_id for r in before.select("doc_id").collect()}
            if k == 1:
                groups = brute_groups([(r.doc_id, r.text) for r in before.collect()])
                assert ids == {i for i, (_, c) in groups.items() if c == i}
            before = after
    assert after.count() == before.count()


def test_sums_over_the_labelled_sample_copy_few_entries():
    rnd = np.random.default_rng(3)
    x = cotraining.Sparse([rnd.integers(0, cotraining.TEXT_SIZE, 1500).astype(np.int32) for _ in range(2000)])
    w, r = rnd.normal(size=x.size), rnd.normal(size=x.n)
    tracemalloc.start()
    back, times = x.back(r), x.times(w)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.array_equal(back, np.bincount(x.feature, r[x.row], minlength=x.size))
    assert np.array_equal(times, np.bincount(x.row, w[x.feature], minlength=x.n))
    assert most < 8e6  # 3 million entries are 24 MB


def test_labelled_sample_is_held_once():
    rnd = np.random.default_rng(7)
    rows = [rnd.choice(cotraining.TEXT_SIZE, n, replace=False).astype(np.int32) for n in [1500] * 1000 + [0, 3, 0, 0] + [1500] * 1000]
    tracemalloc.start()
    x = cotraining.Sparse(rows)
    kept = tracemalloc.get_traced_memory()[0]
    held = x.held()
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    flat = np.concatenate(rows)
    assert kept < 1.2 * flat.nbytes and most < 2 * flat.nbytes
    assert np.array_equal(held, np.bincount(flat, minlength=x.size)) and np.array_equal(x.norms(), [len(r) for r in rows])
    assert np.array_equal(np.concatenate([r for r, _ in x.entries()]), np.repeat(np.arange(len(rows)), [len(r) for r in rows]))


def test_classes_are_what_all_links_connect(spark, monkeypatch):
    rnd = random.Random(31)
    base = [words(rnd, 90, 3000).split() for _ in range(4)]

    def near(p, changes):
        own = list(p)
        for _ in range(changes):
            own[rnd.randrange(len(own))] = f"x{rnd.randrange(10**6)}"
        return " ".join(own)

    rows = [(i, near(base[0], rnd.randint(0, 2))) for i in range(60)]  # a large group of near copies
    rows += [(100 + i, f"{near(base[1 + i % 2], 3)} {words(rnd, 60, 10**6)}") for i in range(20)]
    rows += [(200, " ".join(base[1] + base[2])), (201, rows[3][1]), (202, rows[61][1]), (203, near(base[3], 1)), (204, near(base[3], 4)), (205, words(rnd, 80, 10**6)), (206, ""), (207, None), (None, rows[0][1])]
    rows += [(300 + i, " ".join([*words(rnd, 30, 10**6).split(), *(base[3][i : i + 60]), *words(rnd, 30, 10**6).split()])) for i in range(0, 30, 6)]
    rows += [(400, rows[0][1]), (400, rows[60][1])]
    links = [(r.doc_id, r.other_id) for r in passages.near_passages(docs(spark, rows)).collect()]
    wanted = {i: i for i, _ in rows if i is not None}
    for _ in wanted:
        for a, b in links:
            wanted[a] = wanted[b] = min(wanted[a], wanted[b])
    calls, plain = [], passages.verified_pairs
    monkeypatch.setattr(passages, "verified_pairs", lambda pairs, kept: calls.append(pairs.count()) or plain(pairs, kept))
    got = passages.passage_classes(docs(spark, rows)).collect()
    assert {r.doc_id: r.class_id for r in got} == wanted and len(got) == len(wanted)
    assert len(set(wanted.values())) < 12 and wanted[101] == wanted[100] == wanted[0] != wanted[203]
    assert sum(calls) < len(set(links)) / 2
    known = {frozenset(x) for x in links}
    assert all((r.other_id is None) == (list(wanted.values()).count(r.class_id) == 1) for r in got)
    assert all(frozenset((r.doc_id, r.other_id)) in known and r.similarity >= 0.75 and min(r.n_words, r.other_n_words) >= 50 for r in got if r.other_id is not None)
    assert passages.passage_classes(docs(spark, [])).count() == 0


def test_runs_of_one_word_make_no_pairs_but_long_ones_are_linked(spark, monkeypatch):
    rnd = random.Random(51)
    around = lambda n, k: f"{words(rnd, n, 10**6)}{' of' * k} {words(rnd, n, 10**6)}"
    rows = [(i, around(40, 42)) for i in range(30)]  # runs too short for a passage, in texts that have nothing else in common
    rows += [(100 + i, around(40, 50 + i)) for i in range(6)] + [(200 + i, "by " * (60 - i)) for i in range(3)]
    rows += [(300, f"{words(rnd, 60, 10**6)} of by {'at ' * 49}"), (301, f"{words(rnd, 60, 10**6)} {'at ' * 49}")]
    same = words(rnd, 12, 10**6)
    rows += [(400 + i, f"{words(rnd, 50, 10**6)} {same}{' of' * (34 + i)} {same} {words(rnd, 50, 10**6)}") for i in range(2)]
    calls, plain = [], passages.verified_pairs
    monkeypatch.setattr(passages, "verified_pairs", lambda pairs, kept: calls.append(pairs.count()) or plain(pairs, kept))
    links = passages.near_passages(docs(spark, rows)).collect()
    assert {(r.doc_id, r.other_id) for r in links} == {(100 + i, 100) for i in range(1, 6)} | {(201, 200), (202, 200), (401, 400)}
    assert {(r.doc_id, r.start, r.n_words, r.other_start, r.other_n_words) for r in links if 100 < r.doc_id < 300} == {(100 + i, 40, 50 + i, 40, 50) for i in range(1, 6)} | {(200 + i, 0, 60 - i, 0, 60) for i in (1, 2)}
    got = {r.doc_id: r.class_id for r in passages.passage_classes(docs(spark, rows)).collect()}
    assert got == {i: {1: 100, 2: 200}.get(i // 100, 400 if i == 401 else i) for i, _ in rows}
    assert sum(calls) <= 6


def test_min_hashes_of_documents_are_told_apart_without_a_shuffle(spark):
    rows = [(1, [5, 5, 7, 7, 7, 9], [f << 59 | k for k, f in enumerate([0, 0, 3, 3, 3, 0])]), (2, [-4, 5], [1 << 59, 7]), (3, [8], [5 << 59])]
    got = passages.hashes(spark.createDataFrame(rows, "doc_id long, keys array<long>, windows array<long>"))
    assert sorted((r.doc_id, r.key, r.f) for r in got.collect()) == [(1, 5, 0), (1, 7, 3), (1, 9, 0), (2, -4, 1), (2, 5, 0), (3, 8, 5)]
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    several = passages.ends(got, "doc_id").collect()
    assert sorted((r.key, r.doc_id, r.least) for r in several) == [(5, 1, 1), (5, 2, 1)]
