import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tidecast.llm import merkle
from tidecast.llm.merkle import climb, descend, folded, levels_of, merkle_manifest, siblings


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_tree(leaves):
    """(root, per leaf the siblings' texts by level)."""
    proofs, nodes = [[] for _ in leaves], list(leaves)
    at = list(range(len(leaves)))
    while len(nodes) > 1:
        for i, k in enumerate(at):
            first = k // 16 * 16
            proofs[i].append((k - first, nodes[first:k] + nodes[k + 1 : first + 16]))
        at = [k // 16 for k in at]
        nodes = [sha("".join(nodes[i : i + 16])) for i in range(0, len(nodes), 16)]
    return nodes[0], proofs


def plain_manifest(rows, tampered):
    """{line: (leaf, subroot, root, proof_sha256, folded_root)} for rows of (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for line, r in enumerate(rows):
        groups.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, leaf_of(r), line))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: plain_tree([x[2] for x in sorted(groups[s])]) for s in names}
    root, above = plain_tree([trees[s][0] for s in names])
    found = {}
    for s, over in zip(names, above):
        for x, under in zip(sorted(groups[s]), trees[s][1]):
            proof = under + over
            fold = leaf_of(tampered(rows[x[3]]))
            for k, others in proof:
                fold = sha("".join(others[:k] + [fold] + others[k:]))
            told = sha("".join("".join(others) for _, others in proof))
            found[x[3]] = (x[2], trees[s][0], root, told, fold)
    return found


def tampered(row):
    doc_id, text = row[0], row[4]
    if doc_id is None or text is None or zlib.crc32(str(doc_id).encode()) % 5:
        return row
    return (*row[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in text))


def by_query(df):
    text = F.col("text")
    changed = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return merkle_manifest(df, claimed={"text": F.coalesce(changed, text)})


def compare(df):
    rows = [tuple(r[c] for c in ("doc_id", "source", "lang", "n_chars", "text")) for r in df.collect()]
    want = sorted((r[0], *plain_manifest(rows, tampered)[i]) for i, r in enumerate(rows))
    got = sorted((r["doc_id"], r["leaf"], r["subroot"], r["root"], r["proof_sha256"], r["folded_root"]) for r in by_query(df).collect())
    assert got == want
    return got


def test_documents(spark, sf_dir):
    compare(spark.read.parquet(f"{sf_dir}/documents.parquet"))


@pytest.mark.parametrize("span_levels", [1, 2])
def test_many_passes(spark, make_docs, monkeypatch, span_levels):
    """Shorter passes over a hot source, lone sources and sources of whole runs."""
    monkeypatch.setattr(merkle, "LEVELS", span_levels)
    monkeypatch.setattr(merkle, "SPAN", 16**span_levels)
    sizes = {"hot": 700, "a": 1, "b": 16, "c": 17, "d": 256, "e": 257, None: 33, "é": 3, **{f"s{k}": 1 for k in range(30)}}
    rows, i = [], 0
    for source, n in sizes.items():
        for _ in range(n):
            rows.append(((i * 7919) % 100_003, f"Text {i}" if i % 9 else None, "en", source))
            i += 1
    compare(make_docs(rows))


def test_edge_rows(make_docs):
    rows = [(1, None, None, None), (2, "", "en", ""), (3, "Long " * 200_000, "en", "a"), (5, "A:B-", "é", "a"), (9, "X", None, "-")]
    compare(make_docs(rows, clashing=True))
    assert by_query(make_docs(rows).limit(0)).collect() == []
    lone = by_query(make_docs([(7, "One", "en", "a")])).collect()[0]
    assert lone["leaf"] == lone["subroot"] == lone["root"] and lone["proof_sha256"] == sha("")


def test_repeated_rows_and_lost_ids(make_docs):
    rows = [(4, "Same", "en", "a")] * 40 + [(4, "Other", "en", "a")] * 3 + [(None, "No id", "en", "a")] * 20
    df = make_docs(rows)
    got = by_query(df).collect()
    plain = plain_manifest([tuple(r[c] for c in ("doc_id", "source", "lang", "n_chars", "text")) for r in df.collect()], tampered)
    assert {r["root"] for r in got} == {x[2] for x in plain.values()}
    assert len(got) == 63 and all(r["verified"] for r in got if r["doc_id"] is None)
    assert sorted(r["proof_sha256"] for r in got) == sorted(x[3] for x in plain.values())


def test_proofs_lead_to_the_root(make_docs):
    df = make_docs([(k, f"t{k}", "en", f"s{k % 3}") for k in range(120)])
    for r in merkle_manifest(df, proofs=True).collect():
        node = r["leaf"]
        for step in r["proof"]:
            at = 64 * step["place"]
            node = sha(step["siblings"][:at] + node + step["siblings"][at:])
        assert node == r["root"] and r["verified"]
        assert r["proof_sha256"] == sha("".join(s["siblings"] for s in r["proof"]))


def test_text_ids(make_docs):
    df = make_docs([(k, f"t{k}", "en", "a") for k in range(40)]).withColumn("doc_id", F.concat(F.lit("d"), "doc_id"))
    assert {r["doc_id"] for r in merkle_manifest(df).collect()} == {f"d{k}" for k in range(40)}


@pytest.mark.parametrize("n", [1, 2, 16, 17, 256, 257, 4096])
def test_sweeps_of_a_block(n):
    digests = [hashlib.sha256(str(i).encode()).digest() for i in range(n)]
    found = climb(digests, levels_of(n))
    root, proofs = plain_tree([d.hex() for d in digests])
    assert found[-1][0].hex() == root
    seen = []
    for i, path in descend(found, []):
        seen.append(i)
        assert [s.decode() for s in siblings(path)] == ["".join(others) for _, others in proofs[i]]
        assert folded(digests[i], path).hex() == root
    assert seen == list(range(n))[::-1]


def test_no_task_holds_a_hot_source(spark, make_docs, monkeypatch):
    """With a third of the rows in one source the exchange still deals blocks, not sources."""
    monkeypatch.setattr(merkle, "LEVELS", 1)
    monkeypatch.setattr(merkle, "SPAN", 16)
    rows = make_docs([(k, str(k), "en", "hot" if k % 3 else f"s{k}") for k in range(3000)])
    leaves = merkle.numbered(rows.selectExpr("'=' || source AS tree", "doc_id AS id"), "tree", ["id"])
    sent = leaves.select("tree", (F.col("at") / 16).cast("long").alias("block"), "at").repartition(16, "tree", "block")
    sizes = [r[0] for r in sent.groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert max(sizes) < 3 * 3000 / 16
