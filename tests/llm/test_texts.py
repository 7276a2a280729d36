"""Words, token counts, fingerprints and page extraction."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from candlewick.llm import extract, fingerprints, tokens, words
from candlewick.llm import passages
from candlewick.llm.passages import align, compact_windows

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ODD = ["", None, " ", "a", "A  b\tc\nd\x0b e", "é Ü ß \u00a0 x\u2003y", "1-2_3 Käse 日本語 \U0001f600z", "\x00a\x1fb", "x" * 5000, " lead", "trail "]


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


@pytest.mark.parametrize(
    ("ranges", "pattern"), [(words.SPACED, r"[^\x20\x09-\x0D]+"), (words.ALPHANUMERIC, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")]
)
def test_words_are_those_of_the_pattern(ranges, pattern):
    hasher, known = words.Hasher(ranges), {}
    for most in (1, 7, 1 << 20):
        for low, high, data, starts in words.text_chunks(pa.array(ODD), most):
            hashes, bounds = hasher.words(data, starts)
            for row in range(high - low):
                found = re.findall(pattern, (ODD[low + row] or "").translate(LOWER))
                own = hashes[bounds[row] : bounds[row + 1]].tolist()
                assert len(own) == len(found)
                for word, h in zip(found, own, strict=True):
                    assert known.setdefault(word, h) == h
    assert len(set(known.values())) == len(known)


def test_token_counts_equal_the_library(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    random.seed(1)
    long = " ".join("".join(random.choices("abcdefghij", k=random.randint(1, 9))) for _ in range(30_000))
    texts = [*ODD, "hi<|endoftext|> x", "<|endoftext|>", "don't  stop\n\n now ", long, long.replace(" ", "<|endoftext|> ", 3), "word " * 40_000, "12 " * 50_000]
    rows = [(i, text, "clash", 1) for i, text in enumerate(texts)] + [(3, "a", "clash", 1), (None, "b c", "clash", 1)]
    found = tokens.count_tokens(frame(spark, rows, "doc_id long, text string, n_tokens string, id int")).collect()
    assert len(found) == len(rows)
    want = {(i, len((t or "").encode()), len(tokenizer.encode(t or "", add_special_tokens=False).ids)) for i, t, *_ in rows}
    assert {(r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in found} == want
    assert all(r["over_limit"] == (r["n_tokens"] > 512) for r in found)
    fast = tokens.count_tokens(frame(spark, rows, "doc_id long, text string, n_tokens string, id int"), ranks_path=public_tokenizers.path("byte_bpe_50k.tiktoken"))
    assert {(r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in fast.collect()} == want
    assert tokens.count_tokens(frame(spark, [])).count() == 0


def test_pieces_join_to_the_text():
    text = "ab cd. ef  gh é ij kl\nmn op" * 50
    for most in (1, 5, 40):
        assert "".join(tokens.pieces(text, most)) == text


def test_fingerprints_tell_texts_apart():
    text = "one two three four five six seven\nnext line here\n\nnew section one two\n" * 5
    changed = text.replace("seven", "eight", 1)
    a, b = fingerprints.fingerprint(text), fingerprints.fingerprint(changed)
    assert a == fingerprints.fingerprint(text) and a != b
    assert 0.8 < fingerprints.likeness(a, b) < 1 and fingerprints.likeness(a, a) == 1.0
    assert fingerprints.changed_sections(a, b) == [0]
    assert fingerprints.fingerprint(None) == fingerprints.fingerprint("")
    assert fingerprints.likeness(a, fingerprints.fingerprint("")) == 0.0
    assert len({fingerprints.fingerprint(x) for x in ("a b", "a  b", "a b ", "a\nb", "a\n\nb", "a b\n")}) == 6


@pytest.mark.parametrize("rows", [[(1, "alone here")], [], [(i * 7 % 50, f"text {i} " * (i % 5)) for i in range(50)] + [(3, None), (3, "x"), (None, "no id"), (60, "y" * 9)]])
def test_edited_texts_follow_the_order_of_ids(spark, rows):
    found = fingerprints.compare_with_next(frame(spark, [(*r, "c") for r in rows], "doc_id long, text string, part string")).collect()
    ordered = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    want = []
    for (key, text), (_, following) in zip(ordered, ordered[1:] + ordered[:1], strict=True):
        half = len(text) // 2
        new = text[: len(text) - half] + following[:half]
        trees = [fingerprints.fingerprint(x) for x in (text, new, following)]
        digest = hashlib.sha256(new.encode()).hexdigest()
        want.append((str(key), len(text), digest, trees[0], trees[1], fingerprints.likeness(trees[0], trees[1]), fingerprints.likeness(trees[0], trees[2])))
    names = ("n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
    assert sorted((str(r["doc_id"]), *(r[n] for n in names)) for r in found) == sorted(want)
    whole = fingerprints.fingerprints(frame(spark, rows)).collect()
    assert sorted(r["fingerprint"] for r in whole) == sorted(fingerprints.fingerprint(t) for _, t in rows)


def test_compact_windows_are_the_cartesian_trees_ranges():
    rng = np.random.default_rng(0)
    for _ in range(60):
        sizes, least = rng.integers(1, 40, 5), int(rng.integers(1, 9))
        starts = np.r_[0, np.cumsum(sizes)][:-1]
        ends = starts + sizes
        h = rng.integers(1, int(rng.integers(3, 200)), sizes.sum()).astype(np.uint64)
        want = set()
        for s, e in zip(starts, ends, strict=True):
            for c in range(s, e):
                left = max((j for j in range(s, c) if h[j] <= h[c]), default=s - 1) + 1
                right = min((j for j in range(c + 1, e) if h[j] < h[c]), default=e) - 1
                if right - left + 1 >= least:
                    want.add((left, c, right))
        assert set(zip(*(x.tolist() for x in compact_windows(h, starts, ends, least)), strict=True)) == want


def test_align_finds_every_long_run():
    rng = np.random.default_rng(5)
    for _ in range(40):
        a, b = (rng.integers(0, 1 << 30, 300).astype(np.uint32) for _ in range(2))
        b[100:180] = a[50:130]
        b[200:260] = a[200:260]
        found = align(a, b, 46, 0.8)
        assert [(x[0], x[1]) for x in found] == [(50, 130), (200, 260)] and all(x[4] >= 0.8 for x in found)


def test_blocks_of_broken_markup():
    page = "<div class=x>a<p>b &amp; <b>c</b>\n d<br>e<p>f<script>var p='<p>no';</script><ul><li>g<li>h</ul><!-- <p>no --></div>i<p"
    assert [b.text for b in extract.blocks_of(page)] == ["a", "b & c d", "e", "f", "g", "h", "i"]
    assert extract.blocks_of("") == [] and extract.blocks_of("<style>x") == []


@pytest.mark.parametrize(
    "page, want",
    [
        ("<p>a<select><option>A<option>B</select><p>b", ["a", "b"]),
        ("<p>a<select><optgroup><option>A<optgroup><option>B<option>C</select>b", ["a", "b"]),
        ("<html><head><title>t</title><meta name=x><body><p>a<p>b", ["a", "b"]),
        ("<html><head><title>t</title><link rel=x><p>a<div>b", ["a", "b"]),
        ("<head><title>t</title>\n<b>a</b> b<p>c", ["a b", "c"]),
        ("<head><style>x</style> a <p>b", ["a", "b"]),
        ("<head><title>t</title>a", ["a"]),
        ("<head><title>t</title></head><body>a", ["a"]),
        ("<p>a<svg width=1 /><p>b<iframe src='x'/><p>c<svg><path/>no</svg>d", ["a", "b", "c", "d"]),
    ],
)
def test_blocks_after_omitted_end_tags(page, want):
    assert [b.text for b in extract.blocks_of(page)] == want


def test_gradients_are_those_of_the_loss():
    settings = extract.Settings(path_dim=3, word_dim=2, hidden=2)
    model = extract.Labeller.new(settings)
    model.weights = {k: v.astype(np.float64) for k, v in model.weights.items()}
    rng = np.random.default_rng(0)
    x, mask = rng.normal(size=(2, 4, 15)), np.array([[1, 1, 1, 1], [1, 1, 0, 0]], float)
    y = np.array([[1, 0, 1, 1], [0, 1, 0, 0]], float)

    def loss():
        p = model.forward(x, mask)
        return float((-(y * np.log(p) + (1 - y) * np.log(1 - p)) * mask).sum() / mask.sum())

    grads = model.gradients(x, mask, y)
    for name, value in model.weights.items():
        at = tuple(0 for _ in value.shape)
        old, eps = value[at], 1e-3
        value[at] = old + eps
        up = loss()
        value[at] = old - eps
        down = loss()
        value[at] = old
        assert abs((up - down) / (2 * eps) - grads[name][at]) < 2e-3, name


def article(page):
    import html

    inner = re.search(r"<article>(.*)</article>", page, re.S).group(1)
    blocks = (" ".join(html.unescape(re.sub(r"</?b>", "", x)).split()) for x in re.split(r"</?(?:h1|p|br)>", inner))
    return "\n".join(b for b in blocks if b)


def test_pages_give_their_article(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    extra = frame(spark, [(-1, "u", None), (-2, "u", ""), (-3, "u", "<p>"), (-4, None, "<nav><a>Home</a></nav>" * 3000)], "page_id long, url string, html string")
    both = pages.select("page_id", "url", "html").unionByName(extra)
    found = {r["page_id"]: r["text"] for r in extract.extract_text(both).collect()}
    assert len(found) == both.count()
    wrong = [r["page_id"] for r in pages.collect() if found[r["page_id"]] != article(r["html"])]
    assert len(wrong) <= 2, wrong
    assert found[-1] == found[-2] == found[-3] == ""
    assert extract.extract_text(both.limit(0)).count() == 0


def test_labeller_reads_other_layouts():
    rng = np.random.default_rng(99)
    pages = pq.read_table("/root/testdata/sf0.01/pages.parquet")["html"].to_pylist()
    others = [block.text for page in pages[150:] for block in extract.blocks_of(page)]
    model = extract.fit(pages[:150], extract.Settings())
    wrong = total = 0
    for _ in range(150):
        page, truth = extract.compose(rng, others)
        blocks = extract.blocks_of(page)
        if len(blocks) == len(truth):
            wrong += int(((extract.label(model, [blocks])[0] >= 0.5) != np.array(truth)).sum())
            total += len(truth)
    assert wrong < 0.05 * total


def test_pairs_without_a_passage_are_given_up_at_once(monkeypatch):
    """Where the best stretch is too short no purer one is searched for, and none is aligned unless a stretch with enough in common is long enough."""
    calls = []
    for name in ("_best_stretch", "_longest_stretch"):
        own = getattr(passages, name)
        monkeypatch.setattr(passages, name, lambda *x, own=own, name=name: calls.append(name) or own(*x))
    rng = np.random.default_rng(5)
    a, b = rng.integers(0, 1 << 32, 200).astype(np.uint32), rng.integers(0, 1 << 32, 200).astype(np.uint32)
    b[:30], b[100:130] = a[20:50], a[120:150]  # two runs, both too short, with other words between them
    assert align(a, b, 46, 0.8) == [] and calls == ["_best_stretch"]
    calls.clear()
    b[40:90] = a[60:110]
    assert align(a, b, 46, 0.8) == [(60, 110, 40, 90, 1.0)]


def test_open_places_are_aligned_only_where_a_passage_may_hold_an_open_shingle(monkeypatch):
    """Near copies whose last shingles lie behind a change: what is passed over holds none that is not covered, and few pairs are aligned."""
    rng = np.random.default_rng(9)
    original, count = rng.integers(0, 1 << 32, 240).astype(np.uint32), 80
    grams, fresh = [], []
    for i in range(count):
        text = original.copy()
        for at in [222, *rng.integers(0, 215, 5)] if i else []:
            text[at : at + 5] = rng.integers(0, 1 << 32, 5)
        if i % 9 == 4:
            text[100:140] = text[60:100]  # a text that repeats shingles
        grams.append(text)
        fresh.append(np.arange(240) >= 227 if i % 3 else rng.random(240) < 0.1)
    rows = np.zeros(count, dtype=passages._SOUGHT)
    rows["doc"], rows["r"], rows["open"] = np.arange(count), 239, 1
    if "start" in rows.dtype.names:
        rows["start"], rows["end"] = 230, 60
    calls = []
    monkeypatch.setattr(passages, "align", lambda *x: calls.append(1) or align(*x))
    found = list(passages._first_partners(rows, grams, fresh, 46, 0.8))
    covered = np.zeros((count, 240), dtype=bool)
    for m, b, start, end, *rest in found:
        assert b < m and (start, end, *rest) in align(grams[m], grams[b], 46, 0.8) and fresh[m][start:end].any()
        covered[m, start:end] = True
    for m in range(count):
        sought = fresh[m] & np.isin(grams[m], np.concatenate(grams[:m])) if m else np.zeros(240, dtype=bool)
        for b in range(m):
            for start, end, *_ in align(grams[m], grams[b], 46, 0.8):
                assert not (sought & ~covered[m])[start:end].any(), (m, b, start, end)
    assert found and len(calls) <= 0.2 * count * (count - 1) / 2


class Frame:
    """Takes the functions that a frame would run."""

    def __init__(self):
        self.runs = []

    def mapInArrow(self, run, schema):
        self.runs.append(run)
        return self

    def repartitionById(self, parts, column):
        return self


def test_long_lists_are_cut_into_parts_in_proportion(monkeypatch):
    """A list of many parts is dealt out a few times, not once for each two parts, and like places share a part."""
    monkeypatch.setattr(passages, "PART", 16)
    rng = np.random.default_rng(3)
    rows = np.zeros(1600, dtype=passages._PLACE)
    rows["doc"], rows["open"], rows["key"] = rng.permutation(1600), 1, 77
    for name in passages._SIDES:
        rows[name] = np.repeat(rng.integers(1, 1 << 16, 800), 2)
    frame = Frame()
    passages.open_links(frame, 4, 2)
    cut, link = frame.runs
    blocks = list(cut(iter([passages._by_part(rows, np.zeros(len(rows), np.int64), 1)])))
    assert sum(len(body.as_py()) for batch in blocks for body in batch.column(1)) <= 4 * len(rows) * rows.dtype.itemsize
    links = passages._unpack(link(iter(blocks)), passages._LINK)
    pairs = {tuple(sorted(rows["doc"][i : i + 2].tolist(), reverse=True)) for i in range(0, 1600, 2)}
    assert len(pairs & set(zip(links["doc"].tolist(), links["other"].tolist(), strict=True))) >= 0.95 * len(pairs)


@pytest.mark.parametrize("pieces", [1, 2, 8])
def test_pieces_of_a_block_meet_once(pieces):
    """Every open place meets every other one of its block under one key, whatever the number of pieces."""
    rows = np.zeros(60, dtype=passages._SOUGHT)
    rows["doc"], rows["open"], rows["key"], rows["pieces"] = np.arange(60), np.arange(60) % 3 > 0, 5, pieces
    rows = passages._in_pieces(rows)
    seen = []
    for key in np.unique(rows["key"]):
        own = rows[rows["key"] == key]
        seen += [(m, b) for m in own["doc"][(own["open"] == 1) & (own["side"] != 2)] for b in own["doc"][own["side"] != 1] if m != b]
    assert sorted(seen) == [(m, b) for m in range(60) if m % 3 > 0 for b in range(60) if m != b]
    assert len(np.unique(rows["key"])) == pieces**2 and len(rows) <= 60 * 2 * pieces


def test_passages_have_the_similarity_that_is_told():
    """Random pairs: similarities are those of the sets, passages are long enough and apart, and a changed copy is found."""
    rng = np.random.default_rng(6)
    for _ in range(400):
        many = int(rng.choice([30, 300, 1 << 30]))
        a = rng.integers(0, many, rng.integers(46, 160)).astype(np.uint32)
        b = np.concatenate([rng.integers(0, many, rng.integers(0, 50)), a, rng.integers(0, many, rng.integers(0, 50))]).astype(np.uint32)
        changed = rng.random(len(b)) < rng.choice([0, 0.05, 0.3])
        b[changed] = rng.integers(0, many, np.count_nonzero(changed))
        found, before = align(a, b, 46, 0.8), 0
        for start, end, other_start, other_end, near in found:
            mine, theirs = set(a[start:end].tolist()), set(b[other_start:other_end].tolist())
            assert near == len(mine & theirs) / len(mine | theirs) >= 0.8
            assert start >= before and end - start >= 46
            before = end
        assert found or changed.any()
