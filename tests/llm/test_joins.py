"""N-gram join, substring dedup and decontamination against plain versions."""

import hashlib
import random
import re
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.conftest import prose
from turnmill.llm import decontaminate, ngram_join
from turnmill.llm.decontaminate import contaminated, drop_contaminated
from turnmill.llm.graph import components, forest
from turnmill.llm.ngram_join import Threshold, block_links, jaccard_components, one_of_each
from turnmill.llm.substrings import anchors, remove_repeats
from turnmill.llm.text import words

WORD = r"[^\x20\x09-\x0D]+"


def plain_set(text, k=4):
    w = re.findall(WORD, "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def plain_components(rows, percent=85):
    sets = [plain_set(t) for _, t in rows]
    n = len(rows)
    group, degree = list(range(n)), [0] * n
    for a in range(n):
        for b in range(a):
            o = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * o >= percent * (len(sets[a]) + len(sets[b]) - o):
                degree[a] += 1
                degree[b] += 1
                old, new = group[a], group[b]
                group = [new if g == old else g for g in group]
    least = {}
    for (d, _), g in zip(rows, group):
        if d is not None:
            least[g] = min(least.get(g, d), d)
    return Counter((rows[i][0], len(sets[i]), least.get(group[i]), degree[i]) for i in range(n))


def near_copies(seed, n):
    rng = random.Random(seed)
    base = [prose(rng, rng.choice([3, 5, 8, 20, 60, 200])).split() for _ in range(25)]
    rows = []
    for i in range(n):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 5])):
            j = rng.randrange(len(w))
            w[j : j + rng.choice([0, 1])] = [f"w{rng.randrange(300)}"][: rng.choice([0, 1]) or len(w) < 2]
        rows.append((3 * i + 1, " ".join(w).upper() if rng.random() < 0.1 else " ".join(w)))
    return rows


def test_jaccard_components_match_brute_force(frame):
    rows = near_copies(3, 220)
    rows += [(5000, None), (5001, ""), (5003, "one"), (5004, "one"), (5005, "a a a a a a a"), (5006, "a a a a"), (4, rows[0][1]), (4, rows[50][1]), (None, rows[9][1])]
    for chunk in (1_000_000, 1500):
        got = Counter(tuple(r) for r in jaccard_components(frame(rows), chunk=chunk).collect())
        assert got == plain_components(rows)


def test_short_documents_with_one_word_more_are_linked(frame):
    rng = random.Random(21)
    rows = []
    for n in range(1, 14):
        w = [f"d{n}x{j}" for j in range(n)]
        more = [*w, "end"] if rng.random() < 0.5 else ["begin", *w]
        rows += [(10 * n, " ".join(w)), (10 * n + 1, " ".join(more))]
    rows += [(300, prose(rng, 9) + " a"), (200, rows[16][1] + " other")]
    got = Counter(tuple(r) for r in jaccard_components(frame(rows)).collect())
    assert got == plain_components(rows)
    # Sets of 6 shingles in sets of 7: 9 words, and 10.
    assert (91, 7, 90, 1) in got or (91, 7, 90, 2) in got


def test_block_links_of_a_dense_block():
    rng = random.Random(2)
    base = rng.sample(range(10**6), 120)
    sets = [np.array(sorted({*base} - set(rng.sample(base, 6)) | set(rng.sample(range(10**6), 4)))) for _ in range(60)]
    n = np.array([len(s) for s in sets])
    degree, links = block_links(sets, n, np.ones(60, int), None, Threshold(85))
    linked = [[100 * len(set(a) & set(b)) >= 85 * len(set(a) | set(b)) for b in sets] for a in sets]
    assert degree.tolist() == [sum(x) - 1 for x in linked]
    assert len(links) <= 59


def test_one_of_each_keeps_one_row_of_a_group(messy, none):
    got = one_of_each(messy)
    assert got.schema == messy.schema
    rows = got.collect()
    ids = Counter(r["doc_id"] for r in rows)
    # The base text has copies under ids 4, 5 and 6, repeated rows of 4, and one without an id; another text has the
    # id 4 too, is linked to nothing and stays.
    base, *_, other = sorted((x["text"] for x in messy.filter("doc_id = 4").collect()), key=len, reverse=True)
    assert sorted(r["text"] for r in rows if r["doc_id"] == 4) == sorted([base, other]) and len(other.split()) == 80
    assert ids[4] == 2 and not ids[5] and not ids[6]
    assert [r["text"] for r in rows].count(None) == 2 and ids[1] == ids[2] == ids[3] == 1
    assert one_of_each(none).count() == 0 == jaccard_components(none).count()


def test_one_of_each_keeps_unlinked_rows_that_share_a_key_or_have_none(frame):
    rng = random.Random(22)
    texts = [prose(rng, 60) for _ in range(12)]
    rows = [(None, t) for t in texts[:5]] + [(8, t) for t in texts[5:9]] + [(9, texts[9]), (30, texts[10]), (None, texts[11])]
    # Copies: of texts without a key, of one with a repeated key, and under a key that other components have as least one too.
    copies = [(None, texts[0]), (None, texts[1] + " more"), (8, texts[5]), (12, texts[6].upper()), (13, texts[10]), (31, texts[10]), (None, texts[9])]
    left = one_of_each(frame(rows + copies)).collect()
    ids = Counter(r["doc_id"] for r in left)
    assert ids == {None: 6, 8: 4, 9: 1, 13: 1}
    wanted = {x.removesuffix(" more") for x in texts}
    assert {r["text"].removesuffix(" more") for r in left} == wanted and len(left) == len(texts)


def test_components_in_rounds(spark, ws):
    rng = random.Random(1)
    pairs = [(i, i + 1) for i in range(200) if i % 25 != 24] + [(1000 + rng.randrange(50), 1000 + rng.randrange(50)) for _ in range(60)]
    rng.shuffle(pairs)
    group = {}
    for a, b in pairs:
        merged = group.get(a, {a}) | group.get(b, {b})
        for x in merged:
            group[x] = merged
    edges = spark.createDataFrame(pairs, "a long, b long").repartition(7)
    for small in (0, 200_000):
        got = {r["vertex"]: r["component"] for r in components(edges, ws, small=small).collect()}
        assert all(got.get(x, x) == min(g) for x, g in group.items())
    vertex, root = forest(np.array([5, 9, 7]), np.array([7, 3, 5]))
    assert dict(zip(vertex.tolist(), root.tolist())) == {3: 3, 5: 5, 7: 5, 9: 3}


def plain_removal(rows, k=50):
    cut = [re.findall(WORD, t or "") for _, t in rows]
    least = {}
    for (d, _), w in zip(rows, cut):
        for i in range(len(w) - k + 1) if d is not None else ():
            x = tuple(w[i : i + k])
            least[x] = min(least.get(x, d), d)
    out = Counter()
    for (d, _), w in zip(rows, cut):
        gone = {j for i in range(len(w) - k + 1) if d is not None and least[tuple(w[i : i + k])] < d for j in range(i, i + k)}
        out[d, len(w), len(gone), hashlib.sha256(" ".join(x for j, x in enumerate(w) if j not in gone).encode()).hexdigest()] += 1
    return out


@pytest.mark.parametrize("group", [50_000, 150, 0])
def test_substring_removal_matches_brute_force(frame, group):
    rng = random.Random(3)
    passages = [prose(rng, rng.choice([49, 50, 51, 70, 120])).split() for _ in range(6)]
    rows = []
    for i in range(120):
        t = prose(rng, rng.randrange(1, 100)).split()
        for _ in range(rng.choice([0, 1, 2, 3])):
            p = list(rng.choice(passages))
            p = p[rng.randrange(max(1, len(p) - 55)) :]
            if rng.random() < 0.3:
                p[rng.randrange(len(p))] = f"X{rng.randrange(9)}"
            j = rng.randrange(len(t) + 1)
            t[j:j] = p
        rows.append((i * 2, rng.choice([" ", "\n"]).join(t)))
    rows += [(1000 + i, rows[i][1]) for i in range(10)] + [(2000, None), (2001, ""), (2002, " "), (2003, "a " * 200), (2004, "a " * 60)]
    rows += [(2005, "a b " * 80), (2006, "b a " * 80), (4, rows[3][1] + " zz"), (4, rows[2][1]), (None, rows[5][1]), (None, None)]
    got = Counter(tuple(r) for r in remove_repeats(frame(rows), group=group).collect())
    assert got == plain_removal(rows)


def test_substring_removal_on_messy_rows(messy, none):
    rows = [(r["doc_id"], r["text"]) for r in messy.collect()]
    assert Counter(tuple(r) for r in remove_repeats(messy).collect()) == plain_removal(rows)
    assert remove_repeats(none).count() == 0


def test_equal_windows_have_equal_anchors():
    rng = random.Random(9)
    shared = prose(rng, 80)
    w = words(pa.array([prose(rng, 200) + " " + shared + " " + prose(rng, 60), shared, prose(rng, 30)]))
    starts, chosen = anchors(w.fingerprints(), w.first, 50)
    mine = {int(s - 200): int(c) for s, c in zip(starts, chosen) if 200 <= s <= 230}
    other = {int(s - w.first[1]): int(c) for s, c in zip(starts, chosen) if w.first[1] <= s < w.first[2]}
    assert mine == other and len(other) == 31


def edited(rng, text, k):
    letters = list(text)
    for _ in range(k):
        i, how = rng.randrange(len(letters)), rng.randrange(3)
        letters[i : i + (how != 1)] = [] if how == 0 else ["q"]
    return "".join(letters)


def bench_items(rng):
    return [(i, prose(rng, rng.choice([12, 30, 70]), [f"{a}{b}" for a in "ab cd efg hij klm no".split() for b in "st uv wx yz".split()])) for i in range(40)]


def plain_edits(pattern, text):
    """Fewest edits between a pattern and any part of a text."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j - 1] + (p != t), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_passages_with_edits_are_found():
    rng = random.Random(6)
    items = bench_items(rng)
    index = decontaminate.build(items, 128, 64, 0.08, 24)
    texts, truth = [], []
    for _ in range(150):
        item, body = rng.choice(items)
        k = rng.choice([0, 1, 2, 4])
        mine = edited(rng, body, k)
        mine = mine.upper().replace(" ", " \n") if rng.random() < 0.3 else mine
        left = prose(rng, rng.randrange(40)) + " "
        texts.append(left + mine + " " + prose(rng, rng.randrange(40)))
        truth.append((item, len(left), len(left) + len(mine)))
    hits = {}
    for row, item, start, end, _, _ in decontaminate.search(pa.array(texts), index):
        hits.setdefault(row, {})[item] = (start, end)
    for row, (item, start, end) in enumerate(truth):
        assert item in hits[row] and abs(hits[row][item][0] - start) <= 8 and abs(hits[row][item][1] - end) <= 8


def test_hits_are_those_of_plain_alignment():
    rng = random.Random(12)
    items = [(i, prose(rng, 9)) for i in range(6)]
    index = decontaminate.build(items, 128, 64, 0.08, 24)
    texts = [prose(rng, 5) + " " + edited(rng, rng.choice(items)[1], rng.randrange(5)) + " " + prose(rng, 4) for _ in range(60)]
    got = {(r, i) for r, i, *_ in decontaminate.search(pa.array(texts), index)}
    wanted = {(r, i) for r, t in enumerate(texts) for i, body in items if plain_edits(body, t) <= min(int(0.08 * len(body)), int((len(body) - 7) * 0.75 / 8))}
    assert got == wanted


def test_long_and_repetitive_texts(monkeypatch):
    rng = random.Random(13)
    items = bench_items(rng) + [(77, "a " * 100)]
    index = decontaminate.build(items, 128, 64, 0.08, 24)
    text = " ".join([prose(rng, 3000), items[2][1], prose(rng, 2000), "a " * 3000, items[5][1].upper(), prose(rng, 100)])
    whole = decontaminate.search(pa.array([None, text, "", text[:5000]]), index)
    assert {(r, i) for r, i, *_ in whole} >= {(1, items[2][0]), (1, items[5][0]), (1, 77)}
    monkeypatch.setattr(decontaminate, "SEGMENT", 1000)
    again = decontaminate.search(pa.array([None, text, "", text[:5000]]), index)
    # Where a passage fits at many places, the ends of its span may differ by its edits.
    assert [h for h in again if h[1] != 77] == [h for h in whole if h[1] != 77]
    assert [h[:2] for h in again] == [h[:2] for h in whole]


def test_contaminated_rows(spark, messy, none, frame):
    rng = random.Random(7)
    items = [*bench_items(rng), (90, None), (91, ""), (92, "short"), (None, "x" * 90)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = frame([(1, prose(rng, 50)), (2, "é " + items[0][1]), (2, items[1][1]), (3, None), (4, "")])
    rows = contaminated(docs, bench, block_bytes=1500).collect()
    assert {(r["doc_id"], r["item_id"]) for r in rows} >= {(2, 0), (2, 1)} and {r["doc_id"] for r in rows} == {2}
    assert next(r["start"] for r in rows if r["item_id"] == 0) == 2
    assert sorted(r["doc_id"] for r in drop_contaminated(docs, bench, block_bytes=1500).collect()) == [1, 3, 4]
    assert contaminated(messy, bench).count() == 0 and drop_contaminated(messy, bench).count() == messy.count()
    assert contaminated(none, bench).count() == 0 and contaminated(docs, bench.limit(0)).count() == 0
    assert drop_contaminated(messy, bench).schema == messy.schema


def test_rows_without_a_key_meet_their_own_sets_only(frame):
    rng = random.Random(31)
    base = prose(rng, 60).split()
    texts = []
    for i in range(5000):
        copy = list(base)
        copy[rng.randrange(60)] = f"n{i}"
        texts.append(" ".join(copy))
    start = time.monotonic()
    keyed = jaccard_components(frame(list(enumerate(texts)))).collect()
    own = time.monotonic() - start
    for key in (None, 7):
        start = time.monotonic()
        rows = jaccard_components(frame([(key, t) for t in texts])).collect()
        assert time.monotonic() - start < 1.5 * own + 20
        assert sorted((r["n_shingles"], r["n_links"]) for r in rows) == sorted((r["n_shingles"], r["n_links"]) for r in keyed)
        assert {r["component_id"] for r in rows} == {key}


def test_a_third_of_the_rows_repeat_key_and_text(frame):
    rng = random.Random(32)
    texts = [prose(rng, 40) for _ in range(60)]
    rows = [(None, texts[0])] * 40 + [(5, texts[1])] * 20 + list(enumerate(texts, 10)) + [(200, texts[0] + " more")]
    got = jaccard_components(frame(rows)).collect()
    links = Counter((r["doc_id"], r["n_links"], r["component_id"]) for r in got)
    # Forty copies without a key, one under key 10, and a near copy; twenty of key 5 and one under key 11.
    assert links[(None, 41, 10)] == 40 and links[(10, 41, 10)] == 1 and links[(200, 41, 10)] == 1
    assert links[(5, 20, 5)] == 20 and links[(11, 20, 5)] == 1
    assert sum(n for (_, degree, _), n in links.items() if degree == 0) == 58


@pytest.mark.parametrize("limit", [500_000, 5])
def test_postings_of_frequent_hashes_are_split_and_whole(spark, ws, limit):
    rows = [(i, h) for i in range(60) for h in (7, 1000 + i, 2000 + i // 2, *([8] if i % 3 else []))]
    posted = ws.table(spark.createDataFrame(rows, "id long, hash long"), "posted")
    owners = Counter(h for _, h in rows)
    got = ngram_join._shared(posted, "hash", ws, limit)
    want = sorted((i, h, owners[h]) for i, h in rows if owners[h] > 1)
    assert sorted(tuple(r) for r in got.select("id", "hash", "owners").collect()) == want
    none = ngram_join._shared(posted.filter("hash > 10000"), "hash", ws, limit)
    assert none.collect() == []
