"""Every query on odd and on empty tables, against brute force or its SQL."""

import functools
import hashlib
import json
import math
import os
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest
import xxhash
from pyspark.sql import functions as F

from gazette.llm import ORACLES, QUERIES, quality

SMALL = "/root/testdata/sf0.001"


def rows_of(folder, name):
    return pq.read_table(f"{folder}/{name}.parquet").to_pylist()


def result(spark, name, folder):
    return [r.asDict(recursive=True) for r in QUERIES[name](spark, folder).collect()]


def same_rows(a, b):
    return Counter(map(repr, map(sorted_items, a))) == Counter(map(repr, map(sorted_items, b)))


def sorted_items(row):
    return sorted(row.items())


def order(doc):
    return doc["doc_id"] is None, doc["doc_id"], doc["text"] or ""


def grouped(labels):
    """Smallest member of each connected set, given boolean rows."""
    n = len(labels)
    least = np.arange(n)
    while True:
        new = np.array([least[row].min() if row.any() else least[i] for i, row in enumerate(labels)])
        new = new[new] if n else new
        if (new == least).all():
            return least
        least = new


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, empty, name):
    assert QUERIES[name](spark, empty).collect() == []


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    relation = con.sql(ORACLES[name])
    theirs = [dict(zip(relation.columns, r, strict=True)) for r in relation.fetchall()]
    assert same_rows(result(spark, name, SMALL), theirs)


def test_op1(spark, odd):
    docs = rows_of(odd, "documents")
    texts = [(d["text"] or "").encode() for d in docs]
    seen = Counter(t[i : i + 200] for t in texts for i in range(len(t) - 199))
    expected = []
    for d, t in zip(docs, texts, strict=True):
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - 199):
            if seen[t[i : i + 200]] > 1:
                gone[i : i + 200] = True
        left = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        expected.append(
            {
                "doc_id": d["doc_id"],
                "n_bytes": len(t),
                "n_removed": int(gone.sum()),
                "n_spans": runs,
                "kept_sha256": hashlib.sha256(left).hexdigest(),
            }
        )
    assert any(x["n_removed"] for x in expected)
    assert same_rows(result(spark, "op1_suffix_dedup", odd), expected)


def test_op2(spark, odd):
    found = result(spark, "op2_toxicity", odd)
    docs = rows_of(odd, "documents")
    assert Counter(r["doc_id"] for r in found) == Counter(d["doc_id"] for d in docs)
    for r in found:
        text = "" if r["doc_id"] is None else str(r["doc_id"])
        assert r["held_out"] == (zlib.crc32(text.encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)


def test_op3(spark, odd):
    found = result(spark, "op3_tool_calls", odd)
    turns = rows_of(odd, "conversations")
    calls = {
        (t["conv_id"], f"call_{t['turn']}")
        for t in turns
        if t["role"] == "user" and t["conv_id"] is not None and t["turn"] is not None
    }
    with_call = [r for r in found if r["json"] is not None and "no identifier" not in r["errors"]]
    assert calls <= {(r["conv_id"], r["call_id"]) for r in with_call}
    for r in with_call:
        if r["turn"] is not None:
            assert r["depth"] == r["turn"] // 2
        whole = json.loads(r["json"])
        assert r["json"] == json.dumps(whole, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    assert any(r["valid"] for r in found) and any("limit: not of type" in r["errors"] for r in found)
    assert any("arguments are not JSON" in r["errors"] for r in found)
    assert any(r["errors"] == "result without call" and r["conv_id"] == 9 for r in found)
    assert max(r["n_calls"] for r in found) == 2


def units_of(text):
    """[(first word, end, unit)], by the rule as it is stated."""
    words, begins = [], []
    for line in text.lower().encode().split(b"\n"):
        begins += [len(words)] if line.split() else []
        words += line.split()
    v = [int(hashlib.md5(w).hexdigest()[:8], 16) for w in words]
    begins += [
        i
        for i in range(len(v))
        if all(v[i] < x for x in v[max(i - 8, 0) : i]) and all(v[i] <= x for x in v[i + 1 : i + 9])
    ]
    edges = sorted({*begins, len(words)})
    ends = {s: next((e for e in edges if e >= s + 24), None) for s in edges[:-1]}
    return [(s, e, b" ".join(words[s:e])) for s, e in ends.items() if e]


def test_op4(spark, odd):
    """The rule, row by row; rows with equal id and text count as one document."""
    found = result(spark, "op4_line_dedup", odd)
    docs = rows_of(odd, "documents")
    places = defaultdict(set)

    def digest(text):
        value = xxhash.xxh64_intdigest((text or "").encode(), 42)
        return value - (1 << 64 if value >> 63 else 0)

    def place(d, at):
        return (d["doc_id"] is None, d["doc_id"] or 0, digest(d["text"]), at)

    for d in docs:
        for s, _, unit in units_of(d["text"] or ""):
            places[unit].add(place(d, s))
    expected = []
    for d in docs:
        text = d["text"] or ""
        spans = [m.span() for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
        gone, stays = set(), set()
        for s, e, unit in units_of(text):
            if len(places[unit]) > 1:
                (stays if place(d, s) == min(places[unit]) else gone).update(range(s, e))
        kept, starts, at = [], [], 0
        for i, (a, z) in enumerate(spans):
            if i in gone - stays:
                if i - 1 not in gone - stays:
                    kept.append(text[at:a])
                    starts.append(str(a))
                at = z
        kept.append(text[at:])
        expected.append(
            {
                "doc_id": d["doc_id"],
                "n_units": len(units_of(text)),
                "n_removed": len(starts),
                "removed_starts": ",".join(starts),
                "kept_sha256": hashlib.sha256("".join(kept).encode()).hexdigest(),
            }
        )
    assert same_rows(found, expected)
    assert sum(r["n_removed"] > 0 for r in found) > 8


def test_op5(spark, odd):
    found = result(spark, "op5_mix_sources", odd)
    docs = rows_of(odd, "documents")
    sizes = defaultdict(int)
    for d in docs:
        sizes[d["source"]] += len((d["text"] or "").encode().split())
    places = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(places)}
    targets, total = {}, 1.5 * sum(sizes.values())
    while True:  # share by weight, cut what is above, share the rest again
        free = [s for s in places if s not in targets]
        rest = total - sum(targets.values())
        shares = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        above = [s for s in free if shares[s] >= 2 * sizes[s]]
        if not above:
            targets |= shares
            break
        targets |= {s: 2.0 * sizes[s] for s in above}
    source = {}
    for d in docs:
        source.setdefault((d["doc_id"], len((d["text"] or "").encode().split())), set()).add(d["source"])
    taken = defaultdict(int)
    for r in found:
        (s, *others) = source[r["doc_id"], r["size"]]
        assert not others and r["source_size"] == sizes[s]
        assert r["target"] == pytest.approx(targets[s])
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[s] += r["taken"]
    largest = max(r["size"] for r in found)
    assert all(abs(taken[s] - targets[s]) <= largest for s in places)
    assert same_rows(found, result(spark, "op5_mix_sources", odd))


def test_op6(spark, odd):
    found = result(spark, "op6_simhash", odd)
    docs = rows_of(odd, "documents")

    def print_of(text):
        words = (text or "").encode().lower().split()
        parts = [b" ".join(words[i : i + 4]) for i in range(max(len(words) - 3, 1))] if words else []
        hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
        return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))

    prints = [print_of(d["text"]) for d in docs]
    near = np.array([[(p ^ q).bit_count() <= 4 for q in prints] for p in prints])
    groups = grouped(near)
    least = {}
    for g, d in zip(groups, docs, strict=True):
        if d["doc_id"] is not None:
            least[g] = min(least.get(g, d["doc_id"]), d["doc_id"])
    expected = [
        {"doc_id": d["doc_id"], "fingerprint": f"{p:016x}", "component_id": least[g]}
        for d, p, g in zip(docs, prints, groups, strict=True)
    ]
    assert same_rows(found, expected)


def test_op7(spark, odd):
    found = result(spark, "op7_lattice", odd)
    rows = rows_of(odd, "embeddings")

    def usable(r):
        v = r["embedding"]
        return r["label"] is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    good = [usable(r) for r in rows]
    links = np.zeros((len(rows), len(rows)), bool)
    for i, a in enumerate(rows):
        for j, b in enumerate(rows):
            if i != j and good[i] and good[j] and a["label"] == b["label"]:
                if len(a["embedding"]) == len(b["embedding"]):
                    x, y = np.array(a["embedding"], float), np.array(b["embedding"], float)
                    links[i, j] = x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.93
    ours = sum(r["n_links"] for r in found)
    assert 0.9 * links.sum() <= ours <= links.sum()
    plain = {r["vec_id"]: r for r in found if r["vec_id"] is not None}
    for r, g in zip(rows, good, strict=True):
        if not g:
            assert (plain[r["vec_id"]]["n_links"], plain[r["vec_id"]]["kept"]) == (0, True)
    assert plain[0]["n_links"] >= 6 and plain[203]["component_id"] == 0 and not plain[203]["kept"]


def test_op8(spark, odd):
    from gazette.llm.queries import word_tokenizer
    from tokenizers import Tokenizer

    found = result(spark, "op8_best_two_fit", odd)
    tokenizer = Tokenizer.from_file(word_tokenizer())
    expected, total = Counter(), 0
    for d in rows_of(odd, "documents"):
        ids = [*tokenizer.encode(d["text"] or "", add_special_tokens=False).ids, 0]
        total += len(ids)
        for piece, at in enumerate(range(0, len(ids), 2048)):
            part = np.array(ids[at : at + 2048], "<u4").tobytes()
            expected[d["doc_id"], piece, at, len(part) // 4, zlib.crc32(part)] += 1
    assert expected == Counter(
        (r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found
    )
    by = defaultdict(list)
    for r in found:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(by) <= math.ceil(total / 2048) + 1


def test_op9(spark, odd):
    found = result(spark, "op9_edit_embedding", odd)
    docs = sorted(
        ({**d, "text": d["text"] or ""} for d in rows_of(odd, "documents")),
        key=lambda d: (d["doc_id"] is None, d["doc_id"] or 0, d["text"]),
    )
    expected = []
    for d, after in zip(docs, [*docs[1:], docs[0]], strict=True):
        n = len(d["text"])
        new = d["text"][: n - n // 2] + after["text"][: n // 2]
        expected.append((d["doc_id"], n, hashlib.sha256(new.encode()).hexdigest()))
    assert Counter(expected) == Counter((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in found)
    prints = defaultdict(set)
    for d in docs:
        prints[d["text"]] |= {r["fingerprint"] for r in found if r["doc_id"] == d["doc_id"] and r["n_chars"] == len(d["text"])}
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in found)
    assert len({r["fingerprint"] for r in found if r["n_chars"] == len(docs[0]["text"]) and r["doc_id"] in (0, None)}) == 1


def test_op10(spark, odd):
    found = result(spark, "op10_kneser_ney", odd)
    docs = rows_of(odd, "documents")
    assert Counter(r["doc_id"] for r in found) == Counter(d["doc_id"] for d in docs)
    text = {d["doc_id"]: d["text"] or "" for d in docs}
    good = [r for r in found if r["n_bytes"] > 100 and "!!" not in text[r["doc_id"]]]
    poor = [r for r in found if "!!" in text[r["doc_id"]]]
    assert np.median([r["perplexity"] for r in poor]) > 2 * np.median([r["perplexity"] for r in good])
    assert all(r["kept"] for r in found if not r["n_bytes"])


def smoothed_bits(texts, trusted):
    """Bits of texts under a modified Kneser-Ney model of order 4 of the trusted ones, in plain words."""
    counts = [Counter(), Counter(), Counter(), Counter()]
    for t in trusted:
        whole = b"\n\n\n" + t
        counts[3].update(whole[i : i + 4] for i in range(len(t)))
    for n in (2, 1, 0):
        counts[n].update(g[1:] for g in counts[n + 1])
    tables = []
    for c in counts:
        n1, n2, n3, n4 = (sum(v == i for v in c.values()) for i in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
        d2 = min(max(2 - 3 * y * n3 / n2, y), 2) if n2 and n3 else y
        d3 = min(max(3 - 4 * y * n4 / n3, y), 3) if n3 and n4 else y
        total, left = Counter(), Counter()
        for g, v in c.items():
            total[g[:-1]] += v
            left[g[:-1]] += (y, d2, d3)[min(v, 3) - 1]
        tables.append((c, (y, d2, d3), total, left))

    def p(gram):
        if not gram:
            return 1 / 256
        c, d, total, left = tables[len(gram) - 1]
        context = gram[:-1]
        if not total[context]:
            return p(gram[1:])
        own = max(c[gram] - d[min(c[gram], 3) - 1], 0) if c[gram] else 0
        return own / total[context] + left[context] / total[context] * p(gram[1:])

    p = functools.cache(p)
    return [-sum(math.log2(p((b"\n\n\n" + t)[i : i + 4])) for i in range(len(t))) for t in texts]


def test_op10_bits_and_shards(spark, odd):
    found = result(spark, "op10_kneser_ney", odd)
    docs, labels = rows_of(odd, "documents"), defaultdict(list)
    for r in rows_of(odd, "labels"):
        labels[r["doc_id"]].append(r["quality"])
    good = {i for i, q in labels.items() if i is not None and min((x for x in q if x is not None), default=0) == 1}
    trusted = [(d["text"] or "").encode() for d in docs if d["doc_id"] in good]
    expected = smoothed_bits([(d["text"] or "").encode() for d in docs], trusted)
    ours = defaultdict(list)
    for r in found:
        ours[r["doc_id"], r["n_bytes"]].append(r["bits"])
    theirs = defaultdict(list)
    for d, bits in zip(docs, expected, strict=True):
        theirs[d["doc_id"], len((d["text"] or "").encode())].append(bits)
    assert ours.keys() == theirs.keys()
    for key in ours:
        assert sorted(ours[key]) == pytest.approx(sorted(theirs[key]), rel=1e-4, abs=1e-3)
    frame = spark.createDataFrame([(t,) for t in trusted], "text binary")
    texts = [t for t in trusted if t][:12] + [b"~~ unseen ~~"]
    whole, parts = quality.Model.train(frame), quality.Model.train(frame, shard=300)
    assert len(parts.shards) > 3
    assert parts.bits(texts) == pytest.approx(whole.bits(texts), rel=1e-6)


def test_op2_learns_only_outside_the_held_out_quarter(spark, odd):
    found = result(spark, "op2_toxicity", odd)
    docs = rows_of(odd, "documents")
    held = {i: zlib.crc32(("" if i is None else str(i)).encode()) % 4 == 2 for i in {d["doc_id"] for d in docs}}
    assert Counter((r["doc_id"], r["held_out"]) for r in found) == Counter((d["doc_id"], held[d["doc_id"]]) for d in docs)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in found)


def byte_letters():
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


def test_op11(spark, odd):
    """Groups, links and counts by walking over the tokens."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    from gazette.llm.queries import byte_tokenizer, piece_tokenizer

    a_side, b_side = Tokenizer.from_file(byte_tokenizer()), SentencePieceProcessor(model_file=piece_tokenizer())
    a_side.encode_special_tokens = True
    letters = byte_letters()

    def bytes_a(i):
        return bytes(letters[c] for c in a_side.id_to_token(i))

    def bytes_b(i):
        piece = b_side.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b_side.is_byte(i) else piece.replace("▁", " ").encode()

    def spans(ids, of):
        at, out = 0, []
        for i in ids:
            out.append((at, at + len(of(i)), i))
            at = out[-1][1]
        return out

    docs, made, counts = rows_of(odd, "documents"), [], Counter()
    for d in docs:
        text = d["text"] or ""
        a = spans(a_side.encode(" " + text, add_special_tokens=False).ids if text else [], bytes_a)
        b = spans(b_side.encode(text) if text else [], bytes_b)
        whole = (" " + text).encode()
        if any(b"".join(f(x[2]) for x in side) != whole for side, f in ((a, bytes_a), (b, bytes_b))):
            made.append((d["doc_id"], None))
            continue
        links, j = [], 0
        for start, end, x in a:
            while b[j][1] <= start:
                j += 1
            k = j
            while k < len(b) and b[k][0] < end:
                links.append((x, b[k][2]))
                k += 1
        both, groups = {x[1] for x in a} & {y[1] for y in b}, []
        for side in (a, b):
            cut = [[]]
            for _, end, i in side:
                cut[-1].append(str(i))
                if end in both:
                    cut.append([])
            groups.append([",".join(x) for x in cut[:-1]])
        groups = ["|".join(x) for x in zip(*groups, strict=True)]
        counts.update(set(links))
        made.append((d["doc_id"], (len(a), len(b), len(groups), links, ";".join(groups))))
    best = Counter()
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    expected = []
    for doc_id, row in made:
        n_a, n_b, n_groups, links, groups = row or (0, 0, 0, [], None)
        expected.append(
            {
                "doc_id": doc_id,
                "n_a": n_a,
                "n_b": n_b,
                "n_groups": n_groups,
                "n_links": len(links),
                "n_best": sum(counts[x] == best[x[0]] for x in links),
                "count_sum": sum(counts[x] for x in links),
                "groups_sha256": "" if groups is None else hashlib.sha256(groups.encode()).hexdigest(),
            }
        )
    found = result(spark, "op11_galloping_alignment", odd)
    assert same_rows(found, expected)


def test_op12(spark, odd):
    from sentencepiece import SentencePieceProcessor

    from gazette.llm.queries import piece_tokenizer

    library = SentencePieceProcessor(model_file=piece_tokenizer())
    expected = []
    for d in rows_of(odd, "documents"):
        n = len(library.encode(d["text"] or ""))
        expected.append(
            {"doc_id": d["doc_id"], "n_bytes": len((d["text"] or "").encode()), "n_tokens": n, "over_limit": n > 4096}
        )
    assert same_rows(result(spark, "op12_token_counts", odd), expected)


def test_op13(spark, odd):
    """All pairs with Python's integers."""
    rows, anchors = [], {}
    for r in rows_of(odd, "embeddings"):
        v = r["embedding"]
        if None in (r["vec_id"], r["label"], v) or not all(x is not None and math.isfinite(x) for x in v):
            continue
        label = (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"]
        rows.append((r["vec_id"], label, [math.floor(256 * x) for x in v]))
        if r["vec_id"] % 50 == 0:
            anchors[repr(rows[-1])] = rows[-1]
    expected = []
    for anchor, label, v in anchors.values():
        scored = sorted(
            (-sum(x * y for x, y in zip(v, w, strict=True)), i, other)
            for i, other, w in rows
            if i != anchor and len(w) == len(v)
        )
        for p, positive, _ in [x for x in scored if x[2] == label][:5]:
            hard = [(s, i) for s, i, other in scored if other != label and -50 * p <= -100 * s <= -95 * p]
            for rank, (s, i) in enumerate(hard[:3], 1):
                expected.append(
                    {
                        "anchor_id": anchor,
                        "positive_id": positive,
                        "rank": rank,
                        "negative_id": i,
                        "positive_score": -p,
                        "negative_score": -s,
                    }
                )
    found = result(spark, "op13_kronecker_negatives", odd)
    assert same_rows(found, expected)


@pytest.mark.skipif(not os.path.exists("/root/testdata/sf0.1"), reason="test tables are not there")
def test_op2_on_labels_it_has_not_seen(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    found = QUERIES["op2_toxicity"](spark, folder).where("held_out").join(labels, "doc_id")
    counts = {(r.toxic, r.predicted): r["count"] for r in found.groupBy("toxic", "predicted").count().collect()}
    caught, missed, wrong = counts[1, 1], counts.get((1, 0), 0), counts.get((0, 1), 0)
    assert caught / (caught + missed) >= 0.75 and caught / (caught + wrong) >= 0.9
