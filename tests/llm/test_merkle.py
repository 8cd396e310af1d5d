from __future__ import annotations

import hashlib
import zlib

import pytest

from paperlake.llm import merkle
from tests.llm.fixtures import documents, with_clashes


def h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, n_chars) -> str:
    values = [row["doc_id"], row["source"], row["lang"], n_chars, row["text"]]
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def brute_tree(leaves: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """The root, and per leaf its steps (side, sibling) upwards."""
    paths: list[list[tuple[str, str]]] = [[] for _ in leaves]
    nodes, own = leaves, [[i] for i in range(len(leaves))]
    while len(nodes) > 1:
        above, held = [], []
        for i in range(0, len(nodes), 2):
            run = nodes[i : i + 2]
            for j, members in enumerate(own[i : i + 2]):
                for m in members:
                    paths[m].append(("-", "") if len(run) == 1 else ("LR"[1 - j], run[1 - j]))
            above.append(h(*run))
            held.append([m for members in own[i : i + 2] for m in members])
        nodes, own = above, held
    return nodes[0], paths


def brute(rows) -> list[tuple]:
    by_lang: dict = {}
    for r in rows:
        by_lang.setdefault(r["lang"], []).append(r)
    langs = sorted(by_lang, key=lambda x: b"" if x is None else b"=" + x.encode())
    trees = {}
    for lang in langs:
        members = [(r["doc_id"], leaf(r, r["n_chars"]), r) for r in by_lang[lang]]
        members.sort(key=lambda m: (m[0] is not None, m[0] or 0, m[1]))
        trees[lang] = (members, *brute_tree([m[1] for m in members]))
    root, over = brute_tree([trees[lang][1] for lang in langs])
    found = []
    for lang, shared in zip(langs, over):
        members, subroot, paths = trees[lang]
        for (doc_id, own, r), path in zip(members, paths):
            steps = [*path, *shared]
            tampered = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0 and r["n_chars"] is not None
            node = leaf(r, r["n_chars"] + 1) if tampered else own
            for side, sibling in steps:
                node = h(sibling, node) if side == "L" else h(node, sibling)
            proof = h(*(s for _, s in steps))
            found.append((str(doc_id), own, subroot, root, proof, node, node == root))
    return sorted(found)


def rows_of(spark_rows) -> list[tuple]:
    names = ("leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return sorted((str(r["doc_id"]), *(r[n] for n in names)) for r in spark_rows)


@pytest.mark.parametrize("bits", [10, 2])
def test_manifest_is_brute_force(spark, bits):
    docs = with_clashes(documents(spark)).cache()
    got = rows_of(merkle.verified(merkle.manifest(docs, bits)).collect())
    expected = brute(docs.collect())
    assert [g[:4] for g in got] == [e[:4] for e in expected]
    # Equal rows have equal leaves and differ in their places only.
    assert got == expected
    assert {g[-1] for g in got} == {True, False}


@pytest.mark.parametrize("n", [1, 3, 4, 5, 17])
def test_one_tree_of_any_size(spark, n):
    docs = spark.range(n).selectExpr("id as doc_id", "'t' as text", "'en' as lang", "'s' as source", "id as n_chars")
    assert rows_of(merkle.verified(merkle.manifest(docs, 2)).collect()) == brute(docs.collect())


def test_many_trees(spark):
    docs = spark.range(40).selectExpr(
        "id as doc_id", "'' as text", "if(id % 9 = 0, null, char(60 + id % 13)) as lang", "'s' as source", "1 as n_chars"
    )
    assert rows_of(merkle.verified(merkle.manifest(docs)).collect()) == brute(docs.collect())


def test_equal_doc_ids_are_split(spark):
    """Equal rows fill several tasks, so that none holds them all."""
    rows = spark.range(0, 4000, 1, 4).selectExpr("'=en' as tree", "cast(null as long) as doc_id")
    found = merkle.ranked(rows, ["doc_id"])
    assert sorted(r["rank"] for r in found.collect()) == list(range(4000))
    assert {r["n"] for r in found.collect()} == {4000}


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    assert merkle.verified(merkle.manifest(docs)).isEmpty()
