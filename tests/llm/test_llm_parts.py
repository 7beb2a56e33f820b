"""The operators' parts against plain definitions."""

import itertools
import json
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gazette.llm import alignment, common, counts, edits, lattice, negatives, packing, quality, simhash, tools, toxicity
from gazette.llm.graph import components


def test_components_of_chains_and_stars(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(100, 400)] + [(5, i) for i in range(1_000, 3_000)]
    links += [(rng.randrange(5_000, 6_000), rng.randrange(5_000, 6_000)) for _ in range(600)]
    rng.shuffle(links)
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        if a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    frame = spark.createDataFrame([*links, (7, 7), (None, 3)], "a long, b long")
    found = {r.node: r.component for r in components(frame).collect()}
    assert found == {x: find(x) for x in root}


@settings(max_examples=25, deadline=None)
@given(st.integers(0, 6), st.integers(1, 10**7), st.integers(0, 2**32))
def test_masks_meet_every_pair_within_the_radius(radius, n, seed):
    rng = np.random.default_rng(seed)
    sample = rng.integers(-(2**63), 2**63 - 1, 50)
    masks = simhash.plan_masks(sample, n, radius)
    for _ in range(40):
        a = int(rng.integers(0, 2**63))
        b = a
        for bit in rng.choice(64, radius, replace=False):
            b ^= 1 << int(bit)
        assert any(a & m == b & m for m in masks)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 30), max_size=20))
def test_plan_uses_every_length_once(histogram):
    patterns = packing.plan(histogram, 64)
    used = Counter()
    for times, pattern in patterns:
        assert sum(pattern) <= 64
        for length in pattern:
            used[length] += times
    assert used == Counter(histogram)
    bins = sum(times for times, _ in patterns)
    total = sum(length * n for length, n in histogram.items())
    assert bins <= 2 * total / 64 + 1


def test_the_smallest_gives_way_to_two_that_fit_better():
    left = np.zeros(101, np.int64)
    left[[60, 30, 25, 14]] = 1
    assert sorted(packing._replace_smallest([60, 30], left, 10)) == [14, 25, 60]


@pytest.mark.parametrize("path", [None])
@settings(max_examples=60, deadline=None)
@given(text=st.text(alphabet="abcXYZ éÉßİ'’-.,!1٣ \n\t\x0b ́<|endoftext>漢", max_size=60))
def test_words_apart_have_the_ids_of_the_text(path, text):
    import public_tokenizers

    encoder = packing._encoder(public_tokenizers.path("word_bpe_49k.json"))
    whole = encoder.tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(encoder.ids(text.encode()), "<u4").tolist() == whole


def test_e8_decoding_finds_the_nearest_point():
    rng = np.random.default_rng(0)
    x = rng.normal(0, 1, (200, 8))
    found = lattice.decode(x)
    assert np.all(found.sum(1) % 2 == 0)
    whole = np.all(found == np.rint(found), axis=1)
    assert np.all(whole | np.all(found - 0.5 == np.rint(found - 0.5), axis=1))
    for point, near in zip(x, found, strict=True):
        others = near + lattice.NEXT
        assert ((point - near) ** 2).sum() <= ((point - others) ** 2).sum(1).min() + 1e-12


def test_lattice_recall_just_above_the_threshold():
    rng = np.random.default_rng(1)
    a = lattice.unit(rng.normal(size=(3_000, 64)))
    side = rng.normal(size=a.shape)
    side = lattice.unit(side - (side * a).sum(1, keepdims=True) * a)
    cosine = rng.uniform(0.93, 0.97, (len(a), 1))
    b = cosine * a + np.sqrt(1 - cosine**2) * side
    label = np.zeros(len(a), np.int64)
    x, y = lattice.cells(a, label), lattice.cells(b, label)
    met = (x[:, :, :1] == y).any((1, 2)) | (y[:, :, :1] == x).any((1, 2))
    assert met.mean() >= 0.9


def test_vectors_of_another_length_hide_no_links(spark):
    rng = np.random.default_rng(3)
    a = lattice.unit(rng.normal(size=(400, 64)))
    side = rng.normal(size=a.shape)
    side = lattice.unit(side - (side * a).sum(1, keepdims=True) * a)
    cosine = rng.uniform(0.93, 0.97, (len(a), 1))
    b = cosine * a + np.sqrt(1 - cosine**2) * side
    rows = [(i, v.tolist(), 0) for i, v in enumerate(np.concatenate([a, b]))]
    rows += [(5_000 + i, rng.normal(size=32).tolist(), 0) for i in range(100)]
    found = lattice.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))
    links = {r.vec_id: r.n_links for r in found.collect()}
    assert sum(links[i] > 0 and links[400 + i] > 0 for i in range(400)) >= 380
    assert not any(links[5_000 + i] for i in range(100))


def test_kneser_ney_probabilities_add_up(spark):
    texts = [b"the cat sat on the mat", b"a cat and a dog", b"", b"the dog"] * 3
    frame = spark.createDataFrame([(t,) for t in texts], "text binary")
    model = quality.Model.train(frame)
    for context in (b"the", b"zzz", b"\n\n\n", b" ca"):
        bits = model.bits([context + bytes([c]) for c in range(256)])
        before = model.bits([context])[0]
        assert np.exp2(before - bits).sum() == pytest.approx(1, abs=1e-3)
    assert model.bits([b"the cat"])[0] < model.bits([b"qZx&#@!"])[0] / 3


def test_grams_are_counted_in_every_text(spark):
    texts = [b"abcd", b"", b"abcab"]
    frame = spark.createDataFrame([(t,) for t in texts], "text binary")
    counted = {r.gram: r.n for r in quality.count_grams(frame).collect()}
    expected = Counter(
        int.from_bytes((quality.PAD + t)[i : i + 4], "big") for t in texts for i in range(len(t))
    )
    assert counted == expected


def test_rare_and_unseen_languages_stay(spark):
    rng = random.Random(9)
    letters = {"en": "abcdefghijkl", "xx": "mnopqrstuv", "zz": "αβγδεζηθικ"}
    words = {x: ["".join(rng.choices(a, k=5)) for _ in range(300)] for x, a in letters.items()}
    rows, labels = [], []
    for lang, n, trusted in (("en", 400, 260), ("xx", 60, 5), ("zz", 40, 0)):
        for i in range(n):
            rows.append((len(rows), " ".join(rng.choices(words[lang], k=60)), lang))
            if i < trusted:
                labels.append((rows[-1][0], 1))
    junk = [(10_000 + i, "".join(chr(rng.randint(33, 126)) for _ in range(400)), "en") for i in range(30)]
    found = quality.judge(
        spark.createDataFrame(rows + junk, "doc_id long, text string, lang string"),
        spark.createDataFrame(labels, "doc_id long, quality int"),
    ).collect()
    kept = Counter((r.lang, r.doc_id >= 10_000) for r in found if r.kept)
    assert kept["xx", False] == 60 and kept["zz", False] == 40
    assert kept["en", False] >= 395 and not kept["en", True]


def test_pu_learning_separates():
    rng = np.random.default_rng(2)
    sets, positive = [], []
    for i in range(600):
        toxic = i < 100 or rng.random() < 0.2
        sets.append(sorted({int(rng.integers(2, 12)), *([int(rng.integers(0, 2))] if toxic else [])}))
        positive.append(i < 100)
    w, b = toxicity.train(sets, np.array(positive), 12, 0.2)
    assert b + w[:2].min() > 0 > b + w[2:].max()


def test_the_walk_is_that_of_its_definition():
    text = "shared walks over characters " * 7
    codes = edits.classes_of(text)
    spent = edits.walk(codes, np.array([0]), np.array([len(codes)]), np.array([0]))
    moves = np.random.default_rng(1).integers(0, 2, (256, edits.PERIOD)).astype(bool)
    step, expected = 0, []
    for c in codes:
        n = 1
        while not moves[c, step % edits.PERIOD]:
            n, step = n + 1, step + 1
        step += 1
        expected.append(n)
    assert spent.tolist() == expected


def test_edits_stay_near(spark):
    rng = random.Random(3)
    base = ["".join(rng.choice("abcdefghij ") for _ in range(800)) for _ in range(12)]
    rows = [(i, t) for i, t in enumerate(base)] + [(50 + i, t[:300] + "xy" + t[301:]) for i, t in enumerate(base[:6])]
    found = edits.edited_pairs(spark.createDataFrame(rows, "doc_id long, text string"))
    near = {r.doc_id: r.component_id for r in edits.near_texts(found, 0.6).collect()}
    assert sum(near[50 + i] == i for i in range(6)) >= 5
    assert all(near[i] == i for i in range(12))


def test_near_copies_keep_one(spark):
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(400)]
    base = [[rng.choice(words) for _ in range(200)] for _ in range(20)]
    rows = [(i, " ".join(b)) for i, b in enumerate(base)]
    rows += [(100 + i, " ".join([*b[:90], "changed", *b[91:]])) for i, b in enumerate(base)]
    rows += [rows[3], (None, rows[5][1]), (None, "alone here"), (None, "alone here"), (7, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = [(r.doc_id, r.text) for r in simhash.drop_near_copies(docs).collect()]
    assert sorted(i for i, _ in left if i is not None) == sorted([*range(20), 7])
    assert [t for i, t in left if i is None] == ["alone here"]


def test_near_copies_are_found_however_they_were_made(spark):
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(5_000)]

    def some(n):
        return [rng.choice(words) for _ in range(n)]

    def jaccard(a, b):
        a, b = ({tuple(x[i : i + 5]) for i in range(len(x) - 4)} for x in (a, b))
        return len(a & b) / len(a | b)

    rows, likely = [], {"appended": [], "truncated": [], "edited": []}
    for i in range(360):
        n = rng.randint(60, 300)
        base, part = some(n), int(n * rng.uniform(0, 0.22))
        how = list(likely)[i % 3]
        if how == "appended":
            copy = base + some(part)
        elif how == "truncated":
            copy = base[: n - part]
        else:
            copy = list(base)
            for at in rng.sample(range(n), max(part // 10, 1)):
                copy[at] = rng.choice(words)
        rows += [(i, " ".join(base)), (10_000 + i, " ".join(copy))]
        if jaccard(base, copy) >= 0.8:
            likely[how].append(10_000 + i)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = {r.doc_id for r in simhash.drop_near_copies(docs).collect()}
    assert set(range(360)) <= left
    for how, copies in likely.items():
        assert len(copies) > 80 and sum(i in left for i in copies) <= 0.03 * len(copies), how


def test_wide_links_come_from_the_fingerprints(spark):
    """All pairs within PARTS - 2 bits, however the bits lie; nearly all within the radius; none beyond."""
    rng = np.random.default_rng(9)
    base = rng.integers(-(2**63), 2**63, (300, 4))

    def flipped(row, bits):
        out = row.copy().view(np.uint64)
        for bit in bits:
            out[bit // 64] ^= np.uint64(1) << np.uint64(bit % 64)
        return out.view(np.int64)

    spread = [[8 * k + int(rng.integers(8)) for k in rng.permutation(32)[:30]] for _ in base]
    rim = [rng.permutation(256)[:52] for _ in base]
    beyond = [rng.permutation(256)[:53] for _ in base]
    rows = [(i, *b.tolist()) for i, b in enumerate(base)]
    for at, bits in ((1000, spread), (2000, rim), (3000, beyond)):
        rows += [(at + i, *flipped(b, x).tolist()) for i, (b, x) in enumerate(zip(base, bits, strict=True))]
    prints = spark.createDataFrame(rows, "id long, w0 long, w1 long, w2 long, w3 long")
    near = {(min(r), max(r)) for r in simhash.wide_links(prints, 52).collect()}
    whole = np.array([r[1:] for r in rows]).view(np.uint64)
    place = {r[0]: i for i, r in enumerate(rows)}
    for a, b in near:
        assert np.bitwise_count(whole[place[a]] ^ whole[place[b]]).sum() <= 52
    found = Counter(b // 1000 for a, b in near if a < 1000 and b % 1000 == a)
    assert found[1] == 300 and found[2] >= 0.9 * 300 and found[3] == 0


def test_wide_links_in_dealt_buckets(spark, monkeypatch):
    """A chain of fingerprints, each near the next, in buckets of many blocks is one component."""
    monkeypatch.setattr(simhash, "BLOCK", 16)
    rng = np.random.default_rng(10)
    row, rows = rng.integers(0, 2, 256), []
    for i in range(300):
        rows.append((i, *np.packbits(row, bitorder="little").view("<i8").tolist()))
        row = row ^ np.isin(np.arange(256), rng.integers(0, 256, 6))
    prints = spark.createDataFrame(rows, "id long, w0 long, w1 long, w2 long, w3 long")
    links = simhash.wide_links(prints, 6).collect()
    root = list(range(300))
    for a, b in [tuple(r) for r in links] * 9:
        root[a] = root[b] = min(root[a], root[b])
    for _ in range(300):
        root = [root[x] for x in root]
    assert set(root) == {0}


def flipped(rng, rows, bits):
    """Copies of fingerprints, each of which differs in some of the bits that ``bits`` gives."""
    out = np.unpackbits(rows.view(np.uint8), axis=1, bitorder="little")
    for row in out:
        row[bits(rng)] ^= 1
    return np.packbits(out, axis=1, bitorder="little").view("<i8")


def in_every_octet(rng):
    """52 bits, so spread that no octet or only one is free of them."""
    octets = rng.permutation(32)[: 31 + rng.integers(2)]
    first = 8 * octets + rng.integers(0, 8, len(octets))
    rest = np.setdiff1d(np.concatenate([8 * octets + i for i in range(8)]), first)
    return np.concatenate([first, rng.choice(rest, 52 - len(first), replace=False)])


def apart(rows):
    bits = np.unpackbits(np.ascontiguousarray(rows).view(np.uint8), axis=1).astype(int)
    return (bits[:, None] != bits[None]).sum(2)


def test_wide_links_miss_none_within_the_radius(spark):
    """Pairs at the very radius, whose differing bits leave hardly an octet alone."""
    rng = np.random.default_rng(11)
    base = rng.integers(-(2**63), 2**63, (200, 4))
    rows = np.concatenate([base, flipped(rng, base, in_every_octet)])
    prints = spark.createDataFrame(
        [(i, *r) for i, r in enumerate(rows.tolist())], "id long, w0 long, w1 long, w2 long, w3 long"
    )
    links = {(min(r), max(r)) for r in simhash.wide_links(prints, 52).collect()}
    a, b = np.nonzero(np.triu(apart(rows) <= 52, 1))
    assert len(a) >= 200 and links == set(zip(a.tolist(), b.tolist(), strict=True))


def test_near_copies_against_brute_force(spark):
    """What stays is the least of each component of all pairs within the radius."""
    rng = random.Random(12)
    words = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(5_000)]
    texts = []
    for _ in range(500):
        text = [rng.choice(words) for _ in range(rng.randint(60, 120))]
        copy = list(text)
        for at in rng.sample(range(len(text)), round(0.045 * len(text))):
            copy[at] = rng.choice(words)
        texts += [" ".join(text), " ".join(copy)]
    prints = np.array([simhash.majority(simhash.wide_hashes(t.encode(), 5)) for t in texts], np.uint64)
    distance, root = apart(prints), list(range(len(texts)))
    assert (distance[0::2, 1::2].diagonal() <= 52).sum() > 100
    for a, b in zip(*np.nonzero(np.triu(distance <= 52, 1)), strict=True):
        x, y = root[a], root[b]
        root = [min(x, y) if r in (x, y) else r for r in root]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    left = {r.doc_id for r in simhash.drop_near_copies(docs).collect()}
    assert left == set(root)


@pytest.mark.parametrize("by_parts", [False, True])
@pytest.mark.parametrize("radius", [0, 6, 52, 127, 140])
def test_all_near_by_any_parts(monkeypatch, by_parts, radius):
    """Components of rows, of two sets of rows, of a large group among them, whatever is compared how."""
    for name, value in {"A_ROWS": 16, "B_FIELDS": 16, "PENDING": 50, "LARGE": 20}.items():
        monkeypatch.setattr(simhash, name, value)
    parts = simhash.wide_parts(256, 19, radius) if by_parts else [(0, 0, 0)]
    assert sum(t + 1 for _, _, t in simhash.wide_parts(256, 19, radius)) == radius + 1
    monkeypatch.setattr(simhash, "plan_parts", lambda *_: parts)
    rng = np.random.default_rng(13)
    base = rng.integers(-(2**63), 2**63, (70, 4))
    some = min(radius, 52)
    copies = flipped(rng, base[:50], in_every_octet if radius >= 52 else lambda r: r.permutation(256)[:radius])
    group = flipped(rng, base[[60] * 70], lambda r: r.permutation(256)[: r.integers(some // 2 + 1)])
    rim = flipped(rng, group[:5], lambda r: r.permutation(256)[: some - some // 2])
    rows = rng.permutation(np.concatenate([base, copies, group, rim]))
    near = apart(rows) <= radius
    wide = list(np.ascontiguousarray(rows.T))

    def components(links):
        reach = links | np.eye(len(links), dtype=bool)
        for _ in range(8):
            reach = (reach.astype(int) @ reach.astype(int)) > 0
        return reach.argmax(1)

    every = np.arange(len(rows))
    assert (simhash.all_near(every, every, wide, radius).root == components(near)).all()
    first, second = every[::2], every[1::2]
    root = simhash.all_near(first, second, wide, radius).root
    a, b = np.nonzero(near)
    across = a % 2 != b % 2
    assert (root[a[across]] == root[b[across]]).all()
    assert (components(near)[root] == components(near)).all()


def test_plan_compares_all_or_by_parts():
    assert simhash.plan_parts(1_000, 1_000, 52) == [(0, 0, 0)]
    parts = simhash.plan_parts(simhash.TILE, simhash.TILE, 52)
    assert len(parts) > 1 and sum(t + 1 for _, _, t in parts) == 53
    bits = sorted(b for first, width, _ in parts for b in range(first, first + width))
    assert bits == list(range(256))


def test_call_chains_and_cycles(spark):
    calls = [(1, f"c{i}", f"c{i - 1}" if i else None) for i in range(50)]
    calls += [(2, "a", "b"), (2, "b", "a"), (2, "d", "a"), (3, "x", "gone"), (3, "y", "x")]
    frame = spark.createDataFrame(calls, "conv_id long, call_id string, parent_id string")
    found = {(r.conv_id, r.call_id): r.depth for r in tools.depths(frame).collect()}
    assert [found[1, f"c{i}"] for i in range(50)] == list(range(50))
    assert [found[2, x] for x in "abd"] == [None] * 3 and found[3, "x"] == 0 and found[3, "y"] == 1


def test_schemas():
    schema = {
        "type": "object",
        "required": ["q"],
        "additionalProperties": False,
        "properties": {"q": {"type": "string"}, "n": {"type": ["integer", "null"], "minimum": 1}, "l": {"items": {"enum": [1, 2]}}},
    }
    assert tools.violations({"q": "a", "n": None, "l": [1, 2]}, schema) == []
    assert tools.violations({"n": 0, "z": 1, "l": [3]}, schema) == [
        "$.q: missing", "$.l[0]: not an allowed value", "$.n: out of range", "$.z: unknown",
    ]
    assert tools.violations([], schema) == ["$: not of type object"]
    with pytest.raises(ValueError):
        tools.read_arguments('{"a": NaN}')


def test_hot_groups_are_numbered_without_gaps(spark):
    from pyspark.sql import functions as F

    from gazette.llm.common import numbered

    frame = spark.range(3_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") % 3 == 1, "hot").otherwise(
            (F.col("id") % 50).cast("string")
        ).alias("g"),
        "id",
    )
    by = defaultdict(list)
    for r in numbered(frame, "g", F.xxhash64("id"), ["id"], least=10).collect():
        by[r.g].append(r["rank"])
    assert all(sorted(v) == list(range(len(v))) for v in by.values()) and len(by[None]) == 1_000
    assert list(itertools.chain(*by.values())).__len__() == 3_000


@pytest.fixture(scope="module")
def pieces():
    from sentencepiece import SentencePieceProcessor

    from gazette.llm.queries import piece_tokenizer

    return counts.Transducer(piece_tokenizer()), SentencePieceProcessor(model_file=piece_tokenizer())


@settings(max_examples=150, deadline=None)
@given(
    st.lists(
        st.one_of(
            st.text(max_size=40),
            st.text("abcdet▁ \n0é=", max_size=60),
            st.builds(lambda x, n: x * n, st.sampled_from(["a", " ", "ing", "=-", "漢", "<s>"]), st.integers(0, 700)),
        ),
        max_size=8,
    )
)
def test_the_transducer_counts_what_the_library_does(pieces, texts):
    machine, library = pieces
    assert machine.counts(texts).tolist() == [len(x) for x in library.encode(texts)] if texts else True


def test_a_forgetful_transducer_counts_the_same(pieces, monkeypatch):
    machine, library = pieces
    monkeypatch.setattr(counts, "MOST_STATES", 20)
    monkeypatch.setattr(counts, "CHUNK", 7)
    texts = ["internationalisation" * 30, "no " * 50, "x", "reestablishmentarianismus und so weiter"]
    for _ in range(2):
        assert machine.counts(texts).tolist() == [len(library.encode(t)) for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 50)), st.lists(st.integers(0, 50)), st.integers(-5, 60))
def test_gallop_is_a_search(short, long, near):
    a, b = np.sort(np.array(short, np.int64)), np.unique(np.array(long, np.int64))
    found = alignment.gallop(a, b, np.full(len(a), near))
    assert (found == np.searchsorted(b, a)).all()


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**32), st.sampled_from([1.0, 300.0, 1e6, 1e9, 1e19]), st.integers(0, 20), st.integers(0, 9))
def test_packed_products_are_exact(seed, scale, n, size):
    rng = np.random.default_rng(seed)
    a, c = (np.floor(rng.normal(0, scale, (m, size))) for m in (3, n))
    found = negatives.Packed(c, negatives._norms(a)).scores(a)
    for row, x in zip(found.tolist(), a.tolist(), strict=True):
        exact = [sum(int(i) * int(j) for i, j in zip(x, y, strict=True)) for y in c.tolist()]
        assert row == [max(-(2**63), min(2**63 - 1, s)) for s in exact]


def test_types_are_those_of_json():
    assert tools.violations(1.0, {"type": "integer"}) == [] and tools.violations(1.5, {"type": "integer"})
    assert tools.violations(True, {"enum": [1]}) and not tools.violations(1.0, {"enum": [1]})
    assert tools.violations([{"a": True}], {"enum": [[{"a": 1}]]}) and tools.violations(1, {"type": "whole"})


def test_no_reply_of_a_model_ends_the_job(spark):
    replies = ['{"q":1e400}', "[" * 100_000, '{"q":' * 600 + "1" + "}" * 600, '{"q":"\\ud800"}', '{"\\udfff":1}', "", None, '{"q":"fine"}']
    calls = spark.createDataFrame(
        [(1, f"c{i}", i, "t", x, None) for i, x in enumerate(replies)],
        "conv_id long, call_id string, turn int, name string, arguments string, parent_id string",
    )
    results = spark.createDataFrame(
        [(1, f"c{i}", 50, "done") for i in range(len(replies))], "conv_id long, call_id string, turn int, content string"
    )
    schema = {"t": {"type": "object", "additionalProperties": False, "properties": {"q": {"type": "string"}}}}
    found = {r.call_id: r for r in tools.link_calls(calls, results, schema).collect()}
    bad = "arguments are not JSON"
    expected = [bad, bad, bad, "", "$.\\udfff: unknown", bad, bad, ""]
    assert [found[f"c{i}"].errors for i in range(len(replies))] == expected
    assert json.loads(found["c3"].json)["arguments"] == {"q": "\ud800"}
    assert json.loads(found["c1"].json)["arguments"] == replies[1]


def test_features_are_counted_over_all_texts(spark):
    texts = [b"some words, some more", b"Some", b"", b"sometimes words " * 50] * 3
    rows = spark.createDataFrame([(t,) for t in texts], "text binary").repartition(2)
    expected = Counter(f for t in texts for f in toxicity.features(t))
    for held in (1, 7, 10_000):
        counts = toxicity.document_counts(rows, held=held).groupBy("f").sum("n").collect()
        assert {bytes(r.f): r["sum(n)"] for r in counts} == expected


def test_workers_keep_no_words_of_packed_texts(spark):
    import public_tokenizers

    rows = [(i, f"alpha{i} beta gamma{i} delta") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(16)
    made = packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json")).collect()
    assert {r.doc_id for r in made} == set(range(400))

    def held(batches):
        import pyarrow as pa
        from gazette.llm import packing

        for _ in batches:
            pass
        encoders = list(packing._encoders.values())
        words = sum(len(e.known) + len(e.before) for e in encoders)
        yield pa.RecordBatch.from_pydict({"encoders": [len(encoders)], "words": [words]})

    found = spark.range(16, numPartitions=16).mapInArrow(held, "encoders long, words long").collect()
    assert any(r.encoders for r in found)  # the workers are those that packed
    assert not any(r.words for r in found)


@pytest.mark.parametrize("breaks", [False, True])
def test_a_task_gives_its_memory_back_at_its_end(monkeypatch, breaks):
    seen = []
    monkeypatch.setattr(common, "give_back", lambda: seen.append("back"))

    def run(batches):
        try:
            for x in batches:
                yield x + 1
                if breaks:
                    raise ValueError
        finally:
            seen.append("over")

    def drain():
        for x in common.frugal(run)(iter([1, 2])):
            seen.append(x)

    if breaks:
        with pytest.raises(ValueError):
            drain()
    else:
        drain()
    assert seen == [2, *([] if breaks else [3]), "over", "back"]
