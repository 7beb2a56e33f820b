"""Small tables with everything that may go wrong in them, and empty ones."""

import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

WORDS = "the of and to in alpha beta gamma delta rho tau phi chi psi omega ünder él ça".split()
DOCUMENTS = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("text", pa.string()),
        ("lang", pa.string()),
        ("source", pa.string()),
        ("n_chars", pa.int64()),
        # columns that operators use names of
        ("key", pa.string()),
        ("size", pa.string()),
        ("rank", pa.string()),
        ("_d", pa.string()),
        ("copies", pa.string()),
    ]
)


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(WORDS) for _ in range(n))


def documents():
    rng = random.Random(5)
    passage, line = prose(rng, 60), prose(rng, 9)
    texts = [prose(rng, rng.randint(1, 80)) for _ in range(30)]
    texts += [prose(rng, 20) + "\n" + passage + "\n" + prose(rng, 10) for _ in range(4)]
    texts += [line + "\n" + prose(rng, 7) + "\n" + line.upper() for _ in range(6)]
    texts += [texts[0]] * 8 + [texts[3] + " more"] * 2
    texts += ["", None, "   \n\t ", "x", "aaaa " * 300, "é" * 700, "!! " * 150, "one\n" * 9]
    texts += [prose(rng, 9_000)] + [prose(rng, 1_500)] * 2
    texts += [" ".join(w + "!!" for w in prose(rng, 40).upper().split()) for _ in range(5)]
    rows = []
    for i, text in enumerate(texts):
        source = None if i % 11 == 0 else f"src{i % 5}"
        lang = None if i % 13 == 0 else ("en", "de")[i % 2]
        rows.append((i, text, lang, source, None if text is None else len(text)))
    rows += [rows[2], rows[2], (2, "another text with the same id", "en", "src1", 29)]
    rows += [(None, texts[0], "en", "src1", 1), (None, None, None, None, None)]
    # whole numbers that a double cannot hold
    rows += [(2**60 + 1, texts[5] + " and more", "en", "src1", 9), (2**60 + 3, texts[31], "de", None, 9)]
    rng.shuffle(rows)
    return [(*r, "k", "s", "r", "d", "c") for r in rows]


def write(folder, name, schema, rows):
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
    arrays = [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
    pq.write_table(pa.table(arrays, schema=schema), folder / f"{name}.parquet")


def tables(folder, docs, few=False):
    rng = random.Random(6)
    write(folder, "documents", DOCUMENTS, docs)
    ids = sorted({d[0] for d in docs if d[0] is not None})
    labels = [
        (i, int("!!" not in str(next(d[1] for d in docs if d[0] == i))), i % 3 == 0, "x") for i in ids
    ]
    labels = [(i, q, int(t), x) for i, q, t, x in labels] + [(None, 1, 1, "x"), (1, None, None, "x")]
    write(
        folder,
        "labels",
        pa.schema([("doc_id", pa.int64()), ("quality", pa.int32()), ("toxic", pa.int32()), ("key", pa.string())]),
        labels if docs else [],
    )
    vectors = []
    for i in range(40):
        base = [rng.gauss(0, 1) for _ in range(64)]
        vectors.append((3 * i, base, i % 3, "x"))
        vectors += [
            (3 * i + j, [x + rng.gauss(0, 0.15 * j) for x in base], i % 3, "x") for j in (1, 2)
        ]
    vectors += [(200 + i, vectors[0][1], 0, "x") for i in range(5)] + [vectors[4]]
    vectors += [(300, None, 1, "x"), (301, [0.0] * 64, 1, "x"), (302, [None] * 64, 1, "x")]
    vectors += [(303, [float("nan")] * 64, 1, "x"), (304, vectors[0][1], None, "x"), (305, [], 1, "x")]
    vectors += [(2**60 + 1, vectors[0][1], 0, "x"), (50 * 2**54, vectors[3][1], 1, "x")]
    vectors += [(None, vectors[0][1], 0, "x"), (306, [1.0, 2.0], 0, "x")]
    write(
        folder,
        "embeddings",
        pa.schema([("vec_id", pa.int64()), ("embedding", pa.list_(pa.float32())), ("label", pa.int32()), ("key", pa.string())]),
        vectors if docs else [],
    )
    turns = []
    for conv in range(6):
        for turn in range(2 * rng.randint(1, 9)):
            role = "assistant" if turn % 2 else "user"
            turns.append((conv, turn, role, prose(rng, rng.randint(1, 30)), "x"))
    turns += [(0, 0, "system", "hello", "x"), turns[0], (9, 3, "assistant", "alone", "x")]
    turns += [(None, 0, "user", "text", "x"), (7, None, "user", None, "x"), (8, 0, "user", None, "x")]
    write(
        folder,
        "conversations",
        pa.schema([("conv_id", pa.int64()), ("turn", pa.int32()), ("role", pa.string()), ("text", pa.string()), ("c", pa.string())]),
        turns if docs else [],
    )
    return str(folder)


@pytest.fixture(scope="session")
def odd(tmp_path_factory):
    return tables(tmp_path_factory.mktemp("odd"), documents())


@pytest.fixture(scope="session")
def empty(tmp_path_factory):
    return tables(tmp_path_factory.mktemp("empty"), [])
