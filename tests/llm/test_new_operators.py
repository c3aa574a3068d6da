"""Filter audit, prefix BPE and Merkle manifest against plain versions, and their odd inputs."""

import hashlib
import random
import re
import zlib
from itertools import permutations

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gasledger.llm import bpe_prefix, byte_transducer, filter_audit, merkle, queries
from tests.conftest import SF_SMALL
from tests.llm.test_edges import LONG, PATH, labels, odd

PICK = "ABCDE"


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


# --- filter audit ------------------------------------------------------------------

def plain_measures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return (len(words), len(set(words)), len(re.findall("[A-Z]", text)), len(text), len(re.findall(r"[#$%&*|]", text)))


def plain_audit(docs, labelled):
    """(part, order, step) -> the seven counts; docs are (doc_id, text, source)."""
    rows = []
    for i, text, source in docs:
        t = text or ""
        n, distinct, capitals, points, symbols = plain_measures(t)
        copy = i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in docs)
        fails = {"A": n < 50, "B": 100 * distinct < 65 * n, "C": 100 * capitals > 5 * points, "D": symbols > 0, "E": copy}
        good = any(d == i and q == 1 for d, q, _ in labelled if i is not None)
        toxic = any(d == i and x == 1 for d, _, x in labelled if i is not None)
        rows.append((source or "", {f for f in PICK if fails[f]}, good, toxic))
    out = {}
    for part in {r[0] for r in rows}:
        shapley = dict.fromkeys(PICK, 0)
        for order in map("".join, permutations(PICK)):
            for k, f in enumerate(order):
                mine = [r for r in rows if r[0] == part]
                left = [r for r in mine if not r[1] & set(order[:k])]
                gone = [r for r in left if f in r[1]]
                shapley[f] += len(gone)
                out[part, order, k + 1] = [len(left) - len(gone), len(gone),
                                           sum(f in r[1] for r in mine) - len(gone), sum(r[1] == {f} for r in mine),
                                           sum(r[2] for r in gone), sum(r[3] for r in gone)]
        for (p, order, k), v in out.items():
            if p == part:
                v.append(shapley[order[k - 1]])
    return {k: tuple(v) for k, v in out.items()}


def audited(spark, docs, known):
    rows = filter_audit.audit(docs, known).collect()
    return {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley)
            for r in rows}


def test_audit_equals_plain_version_on_odd_rows(spark):
    docs, known = odd(spark), labels(spark)
    docs = docs.withColumn("source", F.when(F.col("doc_id") % 2 == 0, "b").when(F.col("doc_id") == 1, None).otherwise(""))
    got = audited(spark, docs, known)
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    assert got == plain_audit(rows, [tuple(r) for r in known.collect()])
    assert {k[0] for k in got} == {"", "b"} and len(got) == 1200


def test_audit_equals_plain_version_on_random_rows(spark):
    rng = random.Random(3)
    texts = [" ".join(rng.choice(["one", "Two", "THREE", "four$", "fünf", "x" * 70, "x" * 71, f"w{rng.randrange(60)}"])
                      for _ in range(rng.choice([0, 1, 49, 50, 51, 80]))) for _ in range(60)]
    rows = [(i, rng.choice(texts), rng.choice(["p", "q", None])) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    known = [(i, rng.randrange(2), rng.randrange(2)) for i in range(0, 200, 3)]
    got = audited(spark, docs, spark.createDataFrame(known, "doc_id long, quality int, toxic int"))
    assert got == plain_audit(rows, known)
    # every order keeps the same rows in the end, and the shares add up to what goes
    for part in "", "p", "q":
        ends = {v[0] for (p, _, k), v in got.items() if p == part and k == 5}
        total = sum(1 for r in rows if (r[2] or "") == part)
        assert len(ends) == 1 and sum(v[6] for (p, o, _), v in got.items() if p == part and o == PICK) == 120 * (total - ends.pop())


def test_audit_of_nothing(spark):
    assert audited(spark, odd(spark).limit(0), labels(spark)) == {}
    assert sum(v[4] + v[5] for v in audited(spark, odd(spark), labels(spark).limit(0)).values()) == 0


def test_transducer_on_odd_texts():
    texts = ["", " ", "a", "A b", "é É\t#", "x" * 64 + " " + "x" * 64 + " " + "x" * 65, "x" * 200 + "a " + "x" * 200 + "b " + "x" * 200 + "a",
             "\x00 \x00\x00 \x1f", "日本 日本\n日", LONG, "Q|&*%$#"]
    found = byte_transducer.transduce([t.encode() for t in texts])
    got = list(zip(*[found[m].tolist() for m in filter_audit.MEASURES]))
    assert got == [plain_measures(t) for t in texts]


def test_colliding_spans_are_told_apart_by_their_bytes():
    rng = random.Random(5)
    words = [rng.choice(["aa", "ab", "abc", "y" * 30, "y" * 31, "z" * 90, "z" * 90 + "q"]).encode() for _ in range(300)]
    flat = np.frombuffer(b" ".join(words) + b" ", np.uint8)
    length = np.array([len(w) for w in words])
    begin = np.cumsum(length + 1) - length - 1
    owner = np.arange(300) // 100
    first = byte_transducer.first_of_kind(flat, begin, length, owner, hashed=np.zeros(300, np.uint64))
    seen, want = set(), []
    for o, w in zip(owner.tolist(), words):
        want.append((o, w) not in seen)
        seen.add((o, w))
    assert first.tolist() == want


# --- prefix BPE --------------------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_ids_and_text_equal_the_library(spark, library):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").unionByName(odd(spark).select("doc_id", "text"))
    rows = bpe_prefix.decode(bpe_prefix.encode(docs, PATH), PATH).collect()
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.n_tokens, bytes(r.ids), r.text) for r in rows)
    want = []
    for r in docs.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        want.append((r.doc_id if r.doc_id is not None else -1, len(ids), np.array(ids, "<u4").tobytes(),
                     library.decode(ids, skip_special_tokens=False)))
    assert got == sorted(want)
    both = bpe_prefix.round_trip(docs, PATH).collect()
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.n_tokens, bytes(r.ids), r.text) for r in both) == got


def test_words_without_any_rule(library):
    rng = random.Random(1)
    letters = [chr(c) for c in range(97, 123)] * 3 + list("'0123456789.,!aeé日ßı́𝔘한Σς")
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 60))) for _ in range(1500)]
    texts += ["a" * n for n in range(1, 200)] + ["ab" * n for n in range(1, 60)] + ["!" * 77, "</w> </w", "ﬁ<|endoftext|>|><|startoftext|"]
    texts += ["the" * 5000, "日" * 2000]
    words = bpe_prefix._Words(bpe_prefix.Vocabulary(PATH))
    ids, counts = words.encode([t.encode() for t in texts])
    ends = np.cumsum(counts).tolist()
    for text, a, b in zip(texts, [0, *ends], ends):
        assert ids[a:b].tolist() == library.encode(text, add_special_tokens=False).ids, text[:60]


def test_every_token_is_its_own_encoding(library):
    vocab = bpe_prefix.Vocabulary(PATH)
    letters = {c: b for b, c in enumerate(vocab.letters)}
    same = 0
    for text, token in library.get_vocab().items():
        if token in vocab.special.values() or not text.endswith(bpe_prefix.END) or vocab.left[token] < 0:
            continue
        data = bytes(letters[c] for c in text[:-len(bpe_prefix.END)])
        try:
            piece = data.decode()
        except UnicodeDecodeError:
            continue
        assert vocab.encode_piece(piece) == [token]
        same += 1
    assert same > 30_000


def test_encoding_nothing(spark):
    assert bpe_prefix.decode(bpe_prefix.encode(odd(spark).limit(0), PATH), PATH).count() == 0
    none = spark.createDataFrame([(1, None), (2, b"")], "doc_id long, ids binary")
    assert [(r.n_tokens, r.text) for r in bpe_prefix.decode(none, PATH).collect()] == [(0, ""), (0, "")]


# --- Merkle manifest ---------------------------------------------------------------

def plain_leaf(*values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_tree(nodes):
    """root and, per node, the siblings on its way up as (left, right)."""
    paths, level, at = [[] for _ in nodes], list(nodes), list(range(len(nodes)))
    while len(level) > 1:
        for j, p in enumerate(at):
            run = p // 3 * 3
            paths[j].append(("".join(level[run:p]), "".join(level[p + 1:run + 3])))
        level = [sha("".join(level[i:i + 3])) for i in range(0, len(level), 3)]
        at = [p // 3 for p in at]
    return level[0], paths


def plain_manifest(docs):
    """sorted (doc_id, leaf, subroot, root, proof, folded_root) for docs of (doc_id, source, lang, n_chars, text)."""
    trees = {}
    for row in docs:
        trees.setdefault(row[1], []).append(row)
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    built = {}
    for name in names:
        rows = sorted(trees[name], key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(*r)))
        built[name] = rows, *plain_tree([plain_leaf(*r) for r in rows])
    root, tops = plain_tree([built[n][1] for n in names])
    out = []
    for name, top in zip(names, tops):
        rows, subroot, paths = built[name]
        for row, path in zip(rows, paths):
            steps = path + top
            text = row[4]
            if row[0] is not None and text is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            node = plain_leaf(*row[:4], text)
            for left, right in steps:
                node = sha(left + node + right)
            out.append((-1 if row[0] is None else row[0], plain_leaf(*row), subroot, root,
                        sha("".join(a + b for a, b in steps)), node))
    return sorted(out)


def made(rows):
    out = [(-1 if r.doc_id is None else r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root) for r in rows]
    assert all(r.verified == (r.folded_root == r.root) for r in rows)
    return sorted(out)


def manifest(docs):
    return merkle.verified(merkle.manifest(docs, merkle.without_newlines())).collect()


def test_manifest_of_odd_rows(spark):
    docs = odd(spark).withColumn("source", F.when(F.col("doc_id") > 6, "z").when(F.col("doc_id") == 2, "").otherwise(F.col("source")))
    rows = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in docs.collect()]
    assert made(manifest(docs)) == plain_manifest(rows)
    assert manifest(docs.limit(0)) == []
    one = docs.where("doc_id = 7")
    only = made(manifest(one))
    assert only[0][1] == only[0][2] == only[0][3] and only[0][4] == sha("")


@pytest.mark.parametrize("size", [4, 82, 2200])
def test_manifest_of_trees_of_every_shape(spark, size):
    """One tree of ``size`` rows beside many of one row, over several stored levels."""
    rows = [(i, "hot", "en", 3, f"a\n{i}") for i in range(size)]
    rows += [(10_000 + i, f"s{i:03d}", None, None, None if i % 3 else "x\ny") for i in range(size % 100)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(7)
    assert made(manifest(docs)) == plain_manifest(rows)


def test_only_every_few_levels_are_stored(spark):
    docs = spark.range(2200).select(F.lit("t").alias("tree"), "id", F.sha2(F.col("id").cast("string"), 256).alias("node"))
    forest = merkle.climb(docs, "id")
    assert [t.count() for t in forest.tiers] == [28, 1]      # 2200 leaves, then the 28 nodes four levels up
    assert forest.tiers[0].select(F.max(F.size("members"))).first()[0] == merkle.WIDTH
    rows = merkle.proofs(forest).collect()
    assert {len(r.path) for r in rows} == {8}


# --- the registered queries --------------------------------------------------------

@pytest.mark.parametrize("name", ["op11_filter_interaction", "op13_merkle_manifest"])
def test_queries_equal_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    found = queries.queries()[name](spark, SF_SMALL)
    columns = sorted(found.columns)
    want = con.sql(queries.oracle_sql()[name])
    assert sorted(want.columns) == columns
    want = sorted(con.sql(f"SELECT {', '.join(columns)} FROM ({queries.oracle_sql()[name]})").fetchall())
    assert sorted(tuple(r) for r in found.select(*columns).collect()) == want
