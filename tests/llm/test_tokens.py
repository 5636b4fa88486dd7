import hashlib
import json
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shardloom.llm import bpe, packing, token_files
from shardloom.llm.pretokens import END_OF_TEXT_ID, vocabulary

tokenizers = pytest.importorskip("tokenizers")
PATH = vocabulary("byte_bpe_50k.json")
LIBRARY = tokenizers.Tokenizer.from_file(PATH)
ENCODER = bpe.text_encoder(PATH)

rng = random.Random(1)
PARTS = ["a", "the", " ", "  ", "\n", "\n\n", "\t", "é", "1", "2024", "'s", "!", "##", "<|endoftext|>", "日本", "🙂", "\xa0", "\x1c", "\x85", "²", "\0", "in", "ing", "ABC", "=" * 9, "are.\nNt", "word, next"]
TEXTS = [None, "", " ", "\n", "a" * 5000, " " * 300, "x " * 20000, "ab" * 3000 + " end", *["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 14))) for _ in range(300)]]


def library_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def own_ids(texts):
    return [np.frombuffer(x, "<u4").tolist() for x in ENCODER.ids(pa.array(texts, pa.string()))]


def test_ids_equal_the_library():
    assert own_ids(TEXTS) == [library_ids(t) for t in TEXTS]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.characters(blacklist_categories=("Cs", "Cn")), max_size=40), max_size=5))
def test_any_texts_equal_the_library(texts):
    assert own_ids(texts) == [library_ids(t) for t in texts]


def test_one_walk_and_many_agree():
    automaton = bpe.load(PATH)
    words = [w.encode() for w in ("therewith", " tokenization", "aaaaaaa", "éé", "=====")]
    ids, sizes = automaton.encode_many(np.frombuffer(b"".join(words), np.uint8), np.array([len(w) for w in words]))
    assert ids.tolist() == [i for w in words for i in automaton.encode(w)]
    assert all(automaton.decode(np.array(automaton.encode(w))) == w for w in words)


def test_small_automaton_by_hand():
    # merges: a b -> ab, ab ab -> abab, b a -> ba
    v = {b"a": 0, b"b": 1, b"ab": 2, b"abab": 3, b"ba": 4}
    automaton = bpe.Automaton(v, [(0, 1), (2, 2), (1, 0)])
    assert automaton.encode(b"ababab") == [3, 2] and automaton.encode(b"bab") == [1, 2] and automaton.encode(b"bba") == [1, 4]


def explicit_automaton(symbols, merges):
    """The construction as it is defined, with all states and arcs: for every merge (u, v) -> w, each state that arcs u
    lead to and that has an arc v is copied without it; arcs u lead to the copy, and w is added beside each of them."""
    arcs = [{s: 0 for s in symbols}]
    for u, v, w in merges:
        after = {arcs[p][u] for p in range(len(arcs)) if u in arcs[p]}
        copies, beyond = {}, {}
        for q in sorted(after):
            if v in arcs[q]:
                beyond[q] = arcs[q][v]
                copies[q] = len(arcs)
                arcs.append({s: r for s, r in arcs[q].items() if s != v})
        for own in arcs:
            if (q := own.get(u)) in copies:
                own[w] = beyond[q]
                own[u] = copies[q]
    return arcs


def merged(word, merges, ids):
    """The textbook: the first merge of the list that applies, at its leftmost place, again and again."""
    out = [ids[bytes([b])] for b in word]
    for u, v, w in merges:
        i = 0
        while i + 1 < len(out):
            if out[i : i + 2] == [u, v]:
                out[i : i + 2] = [w]
            i += 1
    return out


@pytest.mark.parametrize("seed", range(25))
def test_compiled_automaton_equals_the_explicit_one(seed):
    r = random.Random(seed)
    labels = [b"a", b"b", b"c"][: r.choice([1, 2, 3])]
    symbols = list(range(len(labels)))
    merges = []
    while len(merges) < r.choice([3, 8, 20]):
        u, v = r.randrange(len(labels)), r.randrange(len(labels))
        if labels[u] + labels[v] in labels:
            if len(merges) >= 2 and r.random() < 0.2:
                break
            continue
        merges.append((u, v, len(labels)))
        labels.append(labels[u] + labels[v])
    ids = {label: i for i, label in enumerate(labels)}
    automaton = bpe.Automaton(ids, [m[:2] for m in merges])
    arcs = explicit_automaton(symbols, merges)
    assert [not d for d in automaton.dead] == [t in arcs[0] for t in range(len(labels))]
    for last in arcs[0]:
        state = arcs[0][last]
        assert all(own[last] == state for own in arcs if last in own)
        assert {t for t in range(len(labels)) if automaton.arc(last, t)} == set(arcs[state])
    words = [bytes(r.choice(b"abc"[: len(symbols)]) for _ in range(r.randint(1, 90))) for _ in range(60)]
    want = [merged(w, merges, ids) for w in words]
    assert [automaton.encode(w) for w in words] == want
    found, sizes = automaton.encode_many(np.frombuffer(b"".join(words), np.uint8), np.array([len(w) for w in words]))
    assert found.tolist() == [i for w in want for i in w] and sizes.tolist() == [len(w) for w in want]


def test_merges_that_make_one_token_twice_are_refused():
    v = {b"a": 0, b"b": 1, b"ab": 2, b"ba": 3, b"aba": 4}
    with pytest.raises(ValueError, match="same token"):
        bpe.Automaton(v, [(0, 1), (1, 0), (2, 0), (0, 3)])


def test_null_and_repeated_ids(spark):
    rows = [(None, "a b"), (1, "x"), (1, "x"), (1, "y"), (2, None)]
    got = bpe.encode_documents(spark.createDataFrame(rows, "doc_id long, text string"), PATH).collect()
    assert sorted((str(r["doc_id"]), r["decoded"]) for r in got) == sorted((str(i), t or "") for i, t in rows)


def docs_of(spark, texts, extra=True):
    rows = [(i, t, 0, "x") for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, n_tokens long, ids string")
    return frame if extra else frame.select("doc_id", "text")


def test_round_trip_over_a_table(spark):
    rows = bpe.encode_documents(docs_of(spark, TEXTS), PATH, digest=True).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        ids = library_ids(TEXTS[r["doc_id"]])
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((TEXTS[r["doc_id"]] or "").encode()).hexdigest()
    assert bpe.encode_documents(docs_of(spark, TEXTS).limit(0), PATH).count() == 0
    assert {r["decoded"] for r in bpe.encode_documents(docs_of(spark, ["a b", "a b"]), PATH).collect()} == {"a b"}


def test_pieces_and_packing(spark):
    texts = [*TEXTS, "a", "a"]
    pieces = packing.piece_documents(docs_of(spark, texts).repartition(5), PATH, capacity=64)
    rows = packing.pack(pieces.withColumn("offset", pieces["start"]), 64).collect()
    by, sequences = {}, {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for i, text in enumerate(texts):
        ids, at = [*library_ids(text), 2], 0
        for n, r in enumerate(sorted(by[i], key=lambda r: r["piece"])):
            assert (r["piece"], r["start"]) == (n, at) and (n == 0 or r["length"] == 64)
            part = np.array(ids[at : at + r["length"]], "<u4").tobytes()
            assert bytes(r["ids"]) == part and r["ids_crc32"] == zlib.crc32(part)
            at += r["length"]
        assert at == len(ids)
    for slots in sequences.values():
        at = 0
        for offset, length in sorted(slots):
            assert offset == at
            at += length
        assert at <= 64
    assert packing.pack(pieces.limit(0), 64).count() == 0


def best_fit_one_by_one(lengths, capacity):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= n]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - n)
        else:
            rooms.append(capacity - n)
    return len(rooms)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=120))
def test_plan_needs_as_many_sequences_as_best_fit_of_each(lengths):
    histogram = {n: lengths.count(n) for n in set(lengths)}
    rows = packing.plan(histogram, 20)
    used = {}
    for length, first, sequence, each, offset in rows:
        following = [r[1] for r in rows if r[0] == length and r[1] > first]
        for rank in range(first, min(following, default=histogram[length])):
            used.setdefault(sequence + (rank - first) // each, []).append((offset + (rank - first) % each * length, length))
    assert sum(map(len, used.values())) == len(lengths)
    for slots in used.values():
        at = 0
        for offset, length in sorted(slots):
            assert offset == at
            at += length
        assert at <= 20
    assert len(used) == best_fit_one_by_one(lengths, 20)


def test_counts_of_flat_files(spark, tmp_path):
    path = f"file://{tmp_path}/tokens"
    manifest = token_files.write_token_files(docs_of(spark, TEXTS).repartition(3), path, PATH)
    LIBRARY.encode_special_tokens = True
    want = {i: len(library_ids(t)) for i, t in enumerate(TEXTS)}
    LIBRARY.encode_special_tokens = False
    for block in (7, 1000, 1 << 20):
        counts = token_files.token_counts(spark, path, block_tokens=block)
        rows = manifest.join(counts, ["file", "document"]).collect()
        assert {r["doc_id"]: r["n_tokens"] for r in rows} == want and all(r["ended"] for r in rows)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.sampled_from([1, 2, END_OF_TEXT_ID]), max_size=40), st.integers(1, 9))
def test_stitching_equals_one_scan(ids, block):
    import tempfile

    from shardloom.session import local_session

    spark = local_session(4)
    folder = tempfile.mkdtemp()
    np.array(ids, "<u2").tofile(f"{folder}/x.bin")
    want, n, start = [], 0, 0
    for i, t in enumerate(ids):
        if t == END_OF_TEXT_ID:
            want.append((len(want), start, n, True))
            n, start = 0, i + 1
        else:
            n += 1
    if n:
        want.append((len(want), start, n, False))
    got = token_files.token_counts(spark, f"file://{folder}", block_tokens=block).orderBy("document").collect()
    assert [(r["document"], r["start"], r["n_tokens"], r["ended"]) for r in got] == want


def test_size_that_is_not_whole_tokens_is_an_error(spark, tmp_path):
    (tmp_path / "x.bin").write_bytes(b"abc")
    with pytest.raises(Exception, match="whole tokens"):
        token_files.token_counts(spark, f"file://{tmp_path}").collect()


def test_pieces_of_null_and_repeated_ids(spark):
    rows = [(None, "a b"), (1, "x"), (1, "x"), (2, None)]
    got = packing.pack(packing.piece_documents(spark.createDataFrame(rows, "doc_id long, text string"), PATH)).collect()
    assert sorted((str(r["doc_id"]), r["length"]) for r in got) == sorted((str(i), len(library_ids(t)) + 1) for i, t in rows)
    assert sorted(r["offset"] for r in got) == list(np.cumsum([0, *[r["length"] for r in sorted(got, key=lambda r: r["offset"])]])[:-1])
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(packing.piece_documents(empty, PATH)).count() == 0


def test_token_files_of_odd_tables(spark, tmp_path):
    kind = "doc_id long, text string, file string, n_tokens string"
    rows = [(None, "a b", "x", "y"), (1, "x", "x", "y"), (1, "x", "x", "y"), (2, None, "x", "y")]
    path = f"file://{tmp_path}/odd"
    where = token_files.write_token_files(spark.createDataFrame(rows, kind), path, PATH)
    counts = where.join(token_files.token_counts(spark, path), ["file", "document"]).collect()
    assert sorted((str(r["doc_id"]), r["n_tokens"]) for r in counts) == sorted((str(r[0]), len(library_ids(r[1]))) for r in rows)
    nothing = f"file://{tmp_path}/none"
    assert token_files.write_token_files(spark.createDataFrame([], kind), nothing, PATH).count() == 0


def test_ids_that_do_not_fit_are_refused(spark, tmp_path, monkeypatch):
    with pytest.raises(ValueError, match="separator"):
        token_files.write_token_files(spark.createDataFrame([(1, "a")], "doc_id long, text string"), f"file://{tmp_path}/a", PATH, separator=1 << 16)
    big = json.loads(open(PATH, encoding="utf-8").read())
    big["model"]["vocab"] = {t: i + 70_000 for t, i in big["model"]["vocab"].items()}
    (tmp_path / "big.json").write_text(json.dumps(big))
    with pytest.raises(Exception, match="doesn't fit"):
        token_files.write_token_files(spark.createDataFrame([(1, "a")], "doc_id long, text string"), f"file://{tmp_path}/b", str(tmp_path / "big.json"))
