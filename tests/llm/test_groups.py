"""Similarity join, passages, decontamination, chat, mixing: against brute force."""

import itertools
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from candlewick.llm import chat, components, decontaminate, jaccard, mixing, passages

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def near_copies(n, seed, size=60, vocabulary=400):
    """Families of copies with a few words changed, exact copies, short texts and texts of common words."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(vocabulary)}"
    rows = []
    while len(rows) < n:
        base = [word() for _ in range(rng.randrange(1, size))]
        for _ in range(rng.choice([1, 1, 2, 5, 12])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = word()
            if rng.random() < 0.3:
                copy += [word()]
            rows.append((len(rows) * 3 % 1000 + 1000 * (len(rows) // 300), (" " if rng.random() < 0.8 else "\n\t").join(copy)))
    return rows


def components_of(nodes, links):
    parent = {x: x for x in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in nodes}


def brute_join(rows, k, num, den):
    sets = []
    for _, text in rows:
        words = SPACED.findall((text or "").translate(LOWER))
        sets.append({tuple(words[i : i + k]) for i in range(max(len(words) - k + 1, 1))} if words else set())
    links = [
        (i, j) for i, j in itertools.combinations(range(len(rows)), 2)
        if sets[i] and sets[j] and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j])
    ]
    group = components_of(range(len(rows)), links)
    least = defaultdict(list)
    for i, g in group.items():
        least[g].append(rows[i][0])
    ids = {g: min((x for x in own if x is not None), default=None) for g, own in least.items()}
    return sorted((str(rows[i][0]), len(sets[i]), str(ids[group[i]])) for i in range(len(rows)))


@pytest.mark.parametrize(("k", "num", "den", "part"), [(4, 85, 100, 512), (4, 85, 100, 3), (2, 1, 2, 5), (5, 4, 5, 512)])
def test_join_equals_brute_force(spark, k, num, den, part):
    rows = near_copies(260, seed=k + part)
    rows += [(5000, None), (5001, ""), (5002, " \n"), (None, rows[0][1]), (None, "only here"), (7, rows[3][1]), (7, rows[3][1]), (6000, "z " * 3000)]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, key int").repartition(5)
    found = jaccard.jaccard_join(docs, k=k, num=num, den=den, part=part)
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in found.collect()) == brute_join(rows, k, num, den)


def test_join_of_no_rows(spark):
    assert jaccard.jaccard_join(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_divide_skip_finds_all_pairs():
    import numpy as np

    rng = np.random.default_rng(1)
    sets = []
    for _ in range(60):
        base = rng.choice(200, rng.integers(2, 40), replace=False)
        for _ in range(3):
            drop = rng.random(len(base)) > 0.1
            sets.append(np.unique(np.r_[base[drop], rng.choice(200, 1)]).astype(np.int64))
    sizes = np.array([len(s) for s in sets])
    want = {
        (i, j) for i, j in itertools.combinations(range(len(sets)), 2)
        if 10 * len(np.intersect1d(sets[i], sets[j])) >= 7 * len(np.union1d(sets[i], sets[j]))
    }
    got = jaccard.divide_skip(sets, sizes, None, 7, 10)
    assert {tuple(sorted(p)) for p in got} == want and len(got) == len(want)


def test_components_of_chains_and_stars(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5000, 5000), (6000, None)]
    links += [(rng.randrange(2000, 2100), rng.randrange(2000, 2100)) for _ in range(60)]
    found = components.components(spark.createDataFrame(links, "a long, b long")).collect()
    group = {r["node"]: r["component"] for r in found}
    assert len(found) == len(group)
    whole = [x for x in links if None not in x]
    want = components_of(group, whole)
    assert {x for x in itertools.chain(*links) if x is not None} == set(group)
    assert len(set(zip(group.values(), (want[x] for x in group), strict=True))) == len(set(want.values())) == len(set(group.values()))
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("place, part", [(1, 512), (150, 512), (299, 512), (150, 64)])
def test_near_repeats_are_found_wherever_the_original_is(spark, monkeypatch, place, part):
    monkeypatch.setattr(passages, "PART", part)
    rng = random.Random(place)
    word = lambda: f"v{rng.randrange(50_000)}"
    original = [word() for _ in range(60)]
    rows, changed = [], [*range(60)] * 5
    rng.shuffle(changed)
    for i in range(300):
        passage = list(original)
        if i != place:
            passage[changed[i]] = f"changed{i}"
        rows.append((i, " ".join([word() for _ in range(40)] + passage + [word() for _ in range(40)])))
    found = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    sets = [{tuple(text.split()[p : p + 5]) for p in range(40, 96)} for _, text in rows]
    near = {i for i in range(300) if any(len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) for j in range(i))}
    assert len(near) >= 300 - place - 1
    assert all(r["other_id"] < r["doc_id"] for r in found)
    assert len(near - {r["doc_id"] for r in found}) <= 0.02 * len(near)


def test_rows_do_not_grow_with_the_square_of_a_group(spark, monkeypatch):
    rng = random.Random(11)
    word = lambda: f"v{rng.randrange(50_000)}"
    original = [word() for _ in range(150)]
    rows = [(i, " ".join(w if rng.random() > 0.05 else word() for w in original)) for i in range(160)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)

    def covered(longest):
        monkeypatch.setattr(passages, "SHORT", longest, raising=False)
        found = passages.repeated_passages(docs).collect()
        assert all(r["other_id"] < r["doc_id"] and r["similarity"] >= 0.8 for r in found)
        return found, {(r["doc_id"], w) for r in found for w in range(r["start_word"], r["end_word"])}

    # Lists that go to blocks cover what pairs of all places cover, with a few rows for each document.
    found, words = covered(8)
    pairs, all_words = covered(1_000)
    assert len(found) <= 12 * len(rows) and len(found) < len(pairs)
    assert len(all_words - words) <= 0.01 * len(all_words)


def test_passages_of_fifty_words_are_found(spark):
    rng = random.Random(8)
    word = lambda: f"v{rng.randrange(5000)}"
    shared = [[word() for _ in range(n)] for n in (51, 60, 80, 45, 300)]
    rows = []
    for i in range(120):
        text = [word() for _ in range(rng.randrange(0, 200))]
        if i % 2:
            passage = shared[rng.randrange(len(shared))]
            at = rng.randrange(len(text) + 1)
            text = text[:at] + [w.upper() if i % 4 == 1 else w for w in passage] + text[at:]
        rows.append((i, " ".join(text)))
    rows += [(200, rows[4][1]), (201, None), (202, ""), (None, rows[5][1]), (300, "same " * 400), (301, "same " * 300), (5, rows[5][1])]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, body string").repartition(4)
    found = passages.repeated_passages(docs).collect()
    cover, words = defaultdict(set), {}
    for r in found:
        assert r["other_id"] < r["doc_id"] and r["similarity"] >= 0.8 and r["end_word"] - r["start_word"] >= 50
        cover[r["doc_id"]] |= set(range(r["start_word"], r["end_word"]))
    first = {}
    for i, text in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        words[i] = SPACED.findall((text or "").translate(LOWER))
        for p in range(len(words[i]) - 49):
            if first.setdefault(tuple(words[i][p : p + 50]), i) != i:
                assert set(range(p, p + 50)) <= cover[i], (i, p)
    clean = {i for i in range(120) if i % 2 == 0}
    assert not {x for r in found for x in (r["doc_id"], r["other_id"])} & (clean - {4})
    assert passages.repeated_passages(docs.limit(0)).count() == 0


def brute_hits(text, items):
    words = PLAIN.findall((text or "").translate(LOWER))
    hit, found = set(), set()
    for key, item in items:
        own = PLAIN.findall((item or "").translate(LOWER))
        size = min(10, len(own))
        windows = {tuple(own[p : p + size]) for p in range(len(own) - size + 1)} if own else set()
        for p in range(len(words) - size + 1 if own else 0):
            if tuple(words[p : p + size]) in windows:
                hit |= set(range(p, p + size))
                found.add(str(key))
    return len(words), len(hit), sorted(found)


def test_decontamination_equals_brute_force(spark):
    rng = random.Random(4)
    word = lambda: rng.choice(["ä1", "B-c", "dd", "e", "ff", "日本"]) + str(rng.randrange(9))
    items = [(i, " ".join(word() for _ in range(rng.choice([1, 2, 5, 9, 10, 11, 14, 30, 60])))) for i in range(25)]
    items += [(100, None), (101, "..."), (102, items[4][1]), (3, items[4][1])]
    rows = []
    for i in range(150):
        text = [word() for _ in range(rng.randrange(0, 60))]
        own = rng.choice(items)[1] or ""
        parts = own.split()
        a = rng.randrange(len(parts) + 1)
        at = rng.randrange(len(text) + 1)
        rows.append((i, " ".join(text[:at] + parts[a : a + rng.choice([9, 10, 25])] + text[at:])))
    rows += [(200, None), (200, ""), (None, items[9][1]), (7, rows[7][1])]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, row int, item_id int")
    bench = spark.createDataFrame([(*r, "z") for r in items], "item_id long, text string, hash string")
    found = decontaminate.contamination(docs, bench).collect()
    got = sorted((str(r["doc_id"]), r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in found)
    want = sorted((str(i), n, hit, own, hit > 0) for i, t in rows for n, hit, own in [brute_hits(t, items)])
    assert got == want
    assert all(r["n_items"] == len(r["items"]) and sum(s["end"] - s["start"] for s in r["spans"]) == r["n_hit"] for r in found)
    none = decontaminate.contamination(docs, bench.limit(0)).collect()
    assert len(none) == len(rows) and not any(r["contaminated"] for r in none)
    assert decontaminate.contamination(docs.limit(0), bench).count() == 0


TREE = [
    ("a", None, 0.0, "user", "root #1"), ("b", "a", 1.0, "assistant", "good <x>"), ("c", "a", 3.0, "assistant", "better \\"),
    ("d", "b", 5.0, "user", "on b"), ("e", "c", 2.0, "user", "on c"), ("f", "c", None, None, None),
    ("x", "missing", 1.0, "user", "own root"), ("p", "q", 1.0, "user", "cycle"), ("q", "p", 1.0, "user", "cycle"),
    (None, "a", 9.0, "user", "no node"), ("s", "s", 1.0, "user", "own parent"), ("t", "q", 1.0, "user", "below a cycle"),
]


def test_best_branches_of_trees(spark):
    replies = spark.createDataFrame([(*r, "c") for r in TREE], "node string, parent string, score double, role string, text string, path string")
    ranked = chat.branches(replies.filter("node IS NOT NULL"), best=2).groupBy("root", "rank", "leaf").agg(F.sort_array(F.collect_list(F.struct("place", "node"))).alias("p"))
    got = {(r["root"], r["rank"]): [x["node"] for x in r["p"]] for r in ranked.collect()}
    # Scores: a-b-d 6, a-c-e 5, a-c-f 3.
    assert got == {("a", 1): ["a", "b", "d"], ("a", 2): ["a", "c", "e"], ("x", 1): ["x"]}
    done = {r["root"]: r for r in chat.format_trees(replies).collect()}
    assert done["a"]["formatted"] == "### user: root \\h1</turn>\n### assistant: good \\lx></turn>\n### user: on b</turn>\n"
    assert [done["a"]["formatted"][m["start"] : m["end"]] for m in done["a"]["loss_mask"]] == ["good \\lx>"]
    assert chat.format_trees(replies.limit(0)).count() == 0


def test_conversations_read_back(spark):
    rng = random.Random(2)
    bits = ["### ", "</turn>", "\n", "\\", "#", "<", ": ", "é", "\U0001f600", "a", "### assistant: "]
    rows = [(c, t, rng.choice(["user", "assistant", "sys:tem", "", None]), "".join(rng.choice(bits) for _ in range(rng.randrange(9)))) for c in range(30) for t in range(rng.randrange(1, 12))]
    rows += [(40, 0, "user", None), (40, 0, "user", None), (None, 1, "assistant", "x"), (41, None, "assistant", "last"), (41, 3, "user", "first")]
    rows += [(50, t, "user" if t % 2 else "assistant", f"turn {t}") for t in range(70)]
    turns = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    done = chat.format_trees(chat.chained(turns))
    done = done.select("root", chat.read_back(F.col("formatted")).alias("turns"), chat.masked_texts(F.col("formatted"), F.col("loss_mask")).alias("learned")).collect()
    want = defaultdict(list)
    for c, t, role, text in sorted(rows, key=lambda r: (str(r[0]), r[1] is None, r[1] or 0, r[2] is not None, r[2] or "", r[3] or "")):
        want["" if c is None else str(c)].append((role or "", text or ""))
    got = {r["root"].split(":")[0]: ([tuple(t) for t in r["turns"]], r["learned"]) for r in done}
    assert {k: v[0] for k, v in got.items()} == dict(want)
    assert {k: v[1] for k, v in got.items()} == {k: [text for role, text in v if role == "assistant"] for k, v in want.items()}


def water_fill(sizes, weights, share, most):
    left, target, open_ = share * sum(sizes), [0.0] * len(sizes), set(range(len(sizes)))
    while open_:
        total = sum(weights[i] for i in open_)
        full = {i for i in open_ if left * weights[i] / total >= most * sizes[i]}
        if not full:
            for i in open_:
                target[i] = left * weights[i] / total
            break
        for i in full:
            target[i] = most * sizes[i]
            left -= target[i]
        open_ -= full
    return target


def test_mix_meets_its_targets(spark):
    rng = random.Random(6)
    rows = [(i, "w " * rng.randrange(0, 120), rng.choice(["a"] * 9 + ["é", "B", "b", "z", None])) for i in range(3000)]
    rows += [(5000, None, "a"), (5001, "", "empty"), (None, "x y", "a"), (9, "x y", "a"), (9, "x y", "a"), (5002, "w " * 4000, "z")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, rate int")
    found = mixing.mix(docs).collect()
    assert len(found) == len(rows)
    count = lambda t: len(SPACED.findall(t or ""))
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += count(text)
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = dict(zip(order, water_fill([sizes[s] for s in order], [(3, 1, 2)[i % 3] for i in range(len(order))], 1.5, 2.0), strict=True))
    text_of = {(i, count(t), s) for i, t, s in rows}
    targets = {round(want[s], 6) for _, _, s in text_of}
    assert {round(r["target"], 6) for r in found} == targets
    taken, goal = defaultdict(int), {}
    for r in found:
        assert 0 <= r["taken"] <= 2 * r["size"] and r["taken"] == r["copies"] * r["size"]
        taken[r["target"]] += r["taken"]
        goal[r["target"]] = r["source_size"]
    for target, n in taken.items():
        assert abs(n - target) <= 0.01 * target + 3
    again = mixing.mix(docs.repartition(7)).collect()
    assert sorted((str(r["doc_id"]), r["taken"]) for r in again) == sorted((str(r["doc_id"]), r["taken"]) for r in found)
    assert mixing.mix(docs.limit(0)).count() == 0


def test_rates_meet_two_margins(spark):
    cells = spark.createDataFrame([("a", "x", 100.0), ("a", "y", 300.0), ("b", "x", 200.0), ("b", "y", 50.0), (None, "x", 80.0)], "s string, l string, size double")
    by_s = spark.createDataFrame([("a", 500.0), ("b", 150.0), (None, 40.0)], "s string, target double")
    by_l = spark.createDataFrame([("x", 250.0), ("y", 440.0)], "l string, target double")
    rates = mixing.balance(cells, {"s": by_s, "l": by_l}, "size", 100.0).collect()
    total = defaultdict(float)
    for r in rates:
        total[("s", r["s"])] += r["size"] * r["rate"]
        total[("l", r["l"])] += r["size"] * r["rate"]
    want = {("s", "a"): 500, ("s", "b"): 150, ("s", None): 40, ("l", "x"): 250, ("l", "y"): 440}
    assert all(abs(total[k] - v) < 1e-3 for k, v in want.items())
    rate = {(r["s"], r["l"]): r["rate"] for r in rates}
    # Exponential tilt: the rates of two sources have one ratio in every language.
    assert abs(rate["a", "x"] / rate["b", "x"] - rate["a", "y"] / rate["b", "y"]) < 1e-6


@pytest.mark.parametrize("ids", [lambda i: None, lambda i: i % 3, lambda i: 7 if i % 3 else i])
def test_mix_draws_rows_of_one_id_each_for_itself(spark, ids):
    rng = random.Random(11)
    texts = ["w " * rng.randrange(1, 80) for _ in range(40)]
    rows = [(ids(i), rng.choice(texts), "abc"[i % 3], i) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, place int").repartition(5)
    found = mixing.mix(docs, keep=("place",)).collect()
    assert sorted(r["place"] for r in found) == list(range(3000))
    source = {place: s for _, _, s, place in rows}
    taken, target = defaultdict(int), {}
    for r in found:
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[source[r["place"]]] += r["taken"]
        target[source[r["place"]]] = r["target"]
    assert all(abs(taken[s] - target[s]) <= 0.01 * target[s] for s in "abc"), (taken, target)
    again = mixing.mix(docs.repartition(3, "text")).collect()
    seen = lambda rows: sorted((str(r["doc_id"]), r["size"], r["target"], r["copies"]) for r in rows)
    assert seen(again) == seen(found)
