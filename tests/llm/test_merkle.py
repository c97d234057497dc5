"""The Merkle manifest against a recursive construction."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from corpusloom.llm.merkle import folded_root, group_key, leaf_digest, merkle_manifest


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(values):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def brute_tree(leaves):
    """Root and, per leaf, the siblings on its way, from the whole list of leaves."""
    nodes, ways = list(leaves), [[] for _ in leaves]
    below = [[n] for n in range(len(leaves))]
    while len(nodes) > 1:
        runs = [range(k, min(k + 3, len(nodes))) for k in range(0, len(nodes), 3)]
        for run in runs:
            for own in run:
                for leaf in below[own]:
                    ways[leaf] += [nodes[k] for k in run if k != own]
        below = [[leaf for k in run for leaf in below[k]] for run in runs]
        nodes = [digest("".join(nodes[k] for k in run)) for run in runs]
    return nodes[0], ways


def brute_manifest(rows):
    """(id, leaf, subroot, root, siblings) of rows (id, group, text)."""
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append((row[0] is not None, row[0] or 0, leaf_of(row), row[0]))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: brute_tree([leaf for _, _, leaf, _ in sorted(groups[g])]) for g in order}
    root, upper = brute_tree([trees[g][0] for g in order])
    out = []
    for g, more in zip(order, upper):
        for (_, _, leaf, key), way in zip(sorted(groups[g]), trees[g][1]):
            out.append((key, leaf, trees[g][0], root, "".join(way + more)))
    return out


def made(spark, rows, parts=4):
    schema = "doc_id long, source string, text string, position int, task string, n int"
    docs = spark.createDataFrame([(*row, 9, "x", 9) for row in rows], schema).repartition(parts)
    return docs.select(
        group_key("source").alias("group"),
        F.col("doc_id").alias("id"),
        leaf_digest(["doc_id", "source", "text"]).alias("leaf"),
        "text",
    )


def collected(manifest):
    text = lambda name: F.lower(F.hex(name))
    found = manifest.select(
        "id", *(text(name).alias(name) for name in ("leaf", "subroot", "root", "siblings"))
    )
    return sorted(map(tuple, found.collect()), key=str)


def test_against_brute_force(spark):
    rng = random.Random(4)
    rows = []
    for n, source in enumerate([None, "", "a", "é", "Z", "=", "\U0001f600", "￮", *(f"s{k}" for k in range(30))]):
        for _ in range(rng.choice([1, 2, 3, 4, 8, 9, 10, 27, 28, 82, 250])):
            text = rng.choice([None, "", "a\nb", "é" * rng.randrange(99)])
            rows.append((rng.choice([None, rng.randrange(-50, 10**9)]), source, text))
    # Rows that are equal in all, of one id, and of no id.
    rows += [(5, "a", "same")] * 40 + [(5, "a", "other"), (None, "a", None), (None, None, None)]
    manifest = merkle_manifest(made(spark, rows), 2)
    assert collected(manifest) == sorted(brute_manifest(rows), key=str)
    checked = folded_root(manifest, "leaf", "folded").where("folded = root")
    assert checked.count() == len(rows)


@pytest.mark.parametrize("sizes", [[1], [2], [3], [4], [9], [10], [81], [82], [1, 1], [9, 9, 9, 1]])
def test_sizes_around_the_arity(spark, sizes):
    rows = [(k, f"g{g}", f"text {k}") for g, n in enumerate(sizes) for k in range(n)]
    assert collected(merkle_manifest(made(spark, rows, 2), 2)) == sorted(brute_manifest(rows), key=str)


def test_real_blocks(spark):
    rows = [(k, "big" if k % 5 else f"s{k % 3}", f"text {k}") for k in range(3000)]
    assert collected(merkle_manifest(made(spark, rows))) == sorted(brute_manifest(rows), key=str)


def test_changed_leaf_leads_elsewhere(spark):
    rows = [(k, "a", f"text\n{k}") for k in range(30)]
    manifest = merkle_manifest(made(spark, rows).withColumn("tried", F.unhex(F.sha2("text", 256))), 2)
    tried = F.when(F.col("id") % 2 == 0, F.col("tried")).otherwise(F.col("leaf"))
    found = folded_root(manifest.withColumn("tried", tried), "tried", "folded")
    assert sorted(r["id"] for r in found.where("folded = root").collect()) == list(range(1, 30, 2))
    # Columns to keep go along.
    assert {r["id"]: r["text"] for r in found.collect()} == {k: text for k, _, text in rows}


def test_empty_table(spark):
    manifest = merkle_manifest(made(spark, [], 1))
    assert folded_root(manifest, "leaf", "folded").collect() == []


def test_query_tampers_as_agreed(spark, tmp_path):
    from corpusloom.llm.queries import QUERIES

    rows = [(k, f"s{k % 3}", "en", 5, "a\nb" if k % 2 else "ab") for k in range(20)] + [(20, None, None, None, None)]
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "documents.parquet"))
    found = {r["doc_id"]: r for r in QUERIES["op12_merkle_manifest"](spark, str(tmp_path)).collect()}
    for key, source, lang, n, text in rows:
        assert found[key]["leaf"] == leaf_of((key, source, lang, n, text))
        changed = zlib.crc32(str(key).encode()) % 2 == 0 and "\n" in (text or "")
        assert found[key]["verified"] != changed
        assert (found[key]["folded_root"] == found[key]["root"]) != changed
