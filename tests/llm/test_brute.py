"""Registered queries against brute force, round trips and held-out accuracy on the smallest tables, and SQL where there is some."""

import collections
import hashlib
import os
import re
import zlib

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tidemark.llm import minhash, packing, queries, secrets, vectors
from tidemark.llm.common import WordHashes, components

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not here")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def read(name):
    return duckdb.sql(f"select * from '{SF_DIR}/{name}.parquet'").fetchall()


def result(spark, name):
    return entry.queries()[name](spark, SF_DIR)


def roots(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def shingles(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def near_groups(rows):
    sets = {i: shingles(t) for i, t in rows}
    ids = sorted(sets)
    links = [(a, b) for a in ids for b in ids if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    return sets, roots(ids, links)


def test_the_queries_are_registered():
    found = entry.queries()
    assert {re.match(r"op\d+|pipeline", n).group() for n in queries.QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(queries.QUERIES) | {"pipeline"} <= set(found)


def test_near_duplicates(spark):
    sets, component = near_groups([r[:2] for r in read("documents")])
    got = result(spark, "op10_minhash_near_dedup").collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got} == {i: (len(s), component[i], component[i] == i) for i, s in sets.items()}


def test_near_duplicates_without_an_original(spark):
    """Groups whose most central member is linked with few: round two must find the other links."""
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for group in range(6):
        own = [f"{group}{w}" for w in base]
        for k in range(30):
            words = list(own)
            for at in rng.choice(120, int(rng.integers(1, 9)), replace=False):
                words[at] = f"x{rng.integers(1 << 40)}"
            rows.append((group * 100 + k, " ".join(words)))
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    _, component = near_groups(rows)
    assert {r["doc_id"]: r["component_id"] for r in got} == component


def test_signature_and_counts():
    words = WordHashes()
    sets = [minhash.shingle_set(" ".join(map(str, range(a, a + 300))), words) for a in (0, 20, 40, 1000)]
    shared = minhash.shared_counts(sets)
    assert shared[0, 1] == 276 and shared[0, 2] == 256 and shared[0, 3] == 0
    assert minhash.similar(sets[0], sets[1]) and not minhash.similar(sets[0], sets[3])


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 102), (102, 101), (7, 7), (100, 102)]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 102: 100}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_code_layout_follows_the_classes():
    assert vectors.Layout.of(0) == vectors.Layout.of(10_000) == vectors.Layout(16, 4)
    for n in (10**5, 10**7, 10**9):
        layout = vectors.Layout.of(n)
        assert n <= 1 << (layout.width - 1) <= 2 * n  # lists of unlike vectors keep their length


@pytest.mark.parametrize(("classes", "mean"), [(2_000, 0.0), (10**7, 0.5), (10**7, 0.8), (10**7, 0.95), (10**9, 0.7)])
def test_recall_of_layouts(classes, mean):
    """Pairs at a cosine just above the threshold meet in a table, whatever component all vectors share."""
    rng = np.random.default_rng(3)
    free = rng.normal(size=(3, 3000, 63))
    u, v = free[0] / np.linalg.norm(free[0], axis=1)[:, None], free[1]
    v -= (u * v).sum(axis=1)[:, None] * u
    v /= np.linalg.norm(v, axis=1)[:, None]
    cosine = 1 - (1 - 0.935) / (1 - mean) if mean < 0.95 else 0.0  # of the free parts; nearly all are links beyond 0.93
    others = free[2] / np.linalg.norm(free[2], axis=1)[:, None]
    a, b, rest = (np.hstack([np.full((3000, 1), np.sqrt(mean)), np.sqrt(1 - mean) * x]) for x in (u, cosine * u + np.sqrt(1 - cosine**2) * v, others))
    assert ((a * b).sum(axis=1) >= vectors.COSINE).all()
    layout, share, spread = vectors.centred_layout(classes, rest)
    quantiser = vectors.Quantiser.learn(rest, layout, rounds=20, share=share)
    apart = vectors.bits_between(quantiser.codes(a), quantiser.codes(b))
    found = (apart <= 2).any(axis=1) & (apart.sum(axis=1) <= layout.radius(spread))
    assert found.mean() >= 0.97


@pytest.mark.parametrize("layout", [None, vectors.Layout(20, 5)])
def test_vectors(spark, layout):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(30, 64))
    spread = rng.uniform(0.05, 0.45, size=(900, 1))
    cloud = centres[rng.integers(0, 30, 900)] + spread * rng.normal(size=(900, 64)) / 1.5
    crowd = centres[:1] + 0.12 * rng.normal(size=(600, 64))  # longer than a block
    data = np.concatenate([cloud, crowd]).astype(np.float32)
    rows = [(i, v.tolist(), int(i % 2)) for i, v in enumerate(data)]
    unit = data.astype(float) / np.linalg.norm(data.astype(float), axis=1)[:, None]
    linked = np.triu(unit @ unit.T >= vectors.COSINE, 1) & (np.arange(1500)[:, None] % 2 == np.arange(1500)[None, :] % 2)
    want = linked.sum(0) + linked.sum(1)
    got = {r["vec_id"]: r for r in vectors.near_vectors(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int"), layout).collect()}
    found = np.array([got[i]["n_links"] for i in range(1500)])
    assert (found <= want).all() and found.sum() >= 0.97 * want.sum() > 0
    component = roots(range(1500), zip(*np.nonzero(linked), strict=True))
    assert np.mean([got[i]["component_id"] == component[i] for i in range(1500)]) > 0.97


def test_vectors_with_a_strong_common_mean(spark):
    rng = np.random.default_rng(8)
    u, v = rng.normal(size=(2, 900, 63))
    u /= np.linalg.norm(u, axis=1)[:, None]
    v -= (u * v).sum(axis=1)[:, None] * u
    v /= np.linalg.norm(v, axis=1)[:, None]
    near = 0.85 * u + np.sqrt(1 - 0.85**2) * v  # a cosine of 0.94 with the common component
    data = np.concatenate([u, near]) * np.sqrt(0.4)
    rows = [(i, [float(np.sqrt(0.6)), *x.tolist()], 0) for i, x in enumerate(data)]
    got = {r["vec_id"]: r["component_id"] for r in vectors.near_vectors(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")).collect()}
    found = np.mean([got[i] == got[900 + i] for i in range(900)])
    print("recall", found)
    assert found >= 0.97


def test_pages(spark):
    got = result(spark, "op1_extract_pages").collect()
    assert len(got) == len(read("pages")) and all(r["n_chars"] == len(r["text"]) > 0 for r in got)
    assert not any(re.search(r"</?(p|b|br|li|nav|article)>", r["text"]) for r in got)


def test_chats(spark):
    got = {r["conv_id"]: r for r in result(spark, "op4_format_chats").collect()}
    conversations = collections.defaultdict(list)
    for c, _, role, text in sorted(read("conversations"), key=lambda r: r[:2]):
        conversations[c].append((role, text))
    conversations[-7] = [("user", queries.CONTROL), ("assistant", queries.CONTROL)]
    assert set(got) == set(conversations)
    for c, turns in conversations.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        assert got[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert got[c]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()


def test_packing(spark):
    got = result(spark, "op5_pack_sequences").collect()
    tokenizer = packing.Tokenizer.from_file(queries.TOKENIZER)
    texts = {r[0]: r[1] for r in read("documents")}
    pieces = collections.defaultdict(list)
    for r in got:
        pieces[r["doc_id"]].append(r)
    assert set(pieces) == set(texts)
    for i, own in pieces.items():
        ids = np.array(tokenizer.encode(texts[i], add_special_tokens=False).ids + [2], "<u4")
        assert sum(r["length"] for r in own) == own[0]["doc_tokens"] == len(ids)
        assert all(r["ids_crc32"] == zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes()) for r in own)
    filled = collections.Counter()
    for r in got:
        filled[r["sequence_id"]] += r["length"]
    assert max(filled.values()) <= 4096 and sum(filled.values()) > 0.95 * 4096 * (len(filled) - 1)


def test_first_fit():
    bins, offsets = packing.first_fit(np.array([7, 6, 5, 4, 3, 2, 1]), 10)
    assert bins.tolist() == [0, 1, 2, 1, 0, 2, 2] and offsets.tolist() == [0, 0, 0, 6, 7, 5, 7]


def test_odd_texts_are_encoded_as_the_tokenizer_does():
    encode, tokenizer = packing.encoder(queries.TOKENIZER), packing.Tokenizer.from_file(queries.TOKENIZER)
    rng = np.random.default_rng(1)
    letters = list("aAbé İΣσς'sre12.,#́  \x1c\n\t²½µßÿ") + ["<|endoftext|>", "ﬁ", "한", "👍", "'re", "naïve"]
    for _ in range(3000):
        text = "".join(rng.choice(letters, rng.integers(0, 25)))
        assert np.frombuffer(encode(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_secrets_match_plain_expressions(spark):
    got = {r["doc_id"]: r for r in result(spark, "op8_secret_scan").collect()}
    for i, text, *_ in read("documents"):
        found = []
        for kind, expression, long in (
            ("assign", secrets.ASSIGN, lambda m: len(m.group(2)) >= 12), ("access", secrets.ACCESS, lambda m: len(m.group()) >= 18), ("hex", secrets.HEX, lambda m: len(m.group()) >= 16),
        ):
            found += [(m.start(), kind, m.end()) for m in expression.finditer(text) if long(m)]
        found.sort(key=lambda s: (s[0], secrets.KINDS.index(s[1])))
        assert got[i]["base_sha256"] == hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, k, e in found).encode()).hexdigest()


def test_rules(spark):
    got = {r["doc_id"]: r for r in result(spark, "op9_quality_rules").collect()}
    for i, text, *_ in read("documents"):
        words = WORD.findall(text)
        lines = [x for x in text.split("\n") if WORD.search(x)]
        seen = collections.Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
        held = {k + j for k in range(len(words) - 7) if seen[tuple(words[k : k + 8])] > 1 for j in range(8)}
        r = got[i]
        want = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(held))
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (len(words) < 20 or 100 * len(held) > 30 * len(words))


def test_learned_results_hold_out(spark):
    rows = read("documents")
    languages = {r["doc_id"]: r["lang_pred"] for r in result(spark, "op7_language_id").collect()}
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 3 == 1 and r[2] is not None]
    assert np.mean([languages[r[0]] == r[2] for r in held]) > 0.97
    scores = {r["doc_id"]: r["score"] for r in result(spark, "op6_quality_score").collect()}
    marked = {i: q for i, q, _ in read("labels") if q is not None}
    good, bad = ([scores[i] for i, q in marked.items() if q == x] for x in (1, 0))
    assert np.mean([[g > b for b in bad] for g in good]) > 0.8


def test_mixing_matches_its_sql(spark):
    duck = duckdb.connect()
    duck.execute(f"create view documents as select * from '{SF_DIR}/documents.parquet'")
    found = duck.execute(entry.oracle_sql()["op2_mix_sources"])
    columns = [c[0] for c in found.description]
    got = result(spark, "op2_mix_sources").select(*columns).collect()
    assert sorted(map(tuple, got)) == sorted(found.fetchall())


def test_pipeline(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    documents = {r["doc_id"]: r["text"] for r in rows.collect()}
    after = {}
    docs = rows
    for name, function in corpus_pipeline.STAGES:
        docs = function(spark, docs, SF_DIR).cache()
        after[name] = docs.collect()
    assert {r["doc_id"] for r in after["language"]} == {i for i, t in documents.items() if any(c.isalpha() for c in t)}
    _, component = near_groups([(r["doc_id"], r["text"]) for r in after["language"]])
    assert sorted(r["doc_id"] for r in after["near_duplicates"]) == sorted(set(component.values()))
    words = secrets.automaton()
    assert len(after["secrets"]) == len(after["near_duplicates"]) and not any(secrets.spans_of(r["text"], words) for r in after["secrets"])
    taken = collections.Counter(r["doc_id"] for r in after["mixing"])
    assert max(taken.values()) <= 3 and set(taken) <= {r["doc_id"] for r in after["secrets"]}
    assert collections.Counter(r["doc_id"] for r in after["packing"] if r["start"] == 0) == taken
