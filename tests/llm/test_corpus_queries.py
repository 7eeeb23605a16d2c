"""Every query against its SQL, or a plain version over the whole table."""

import base64
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import reference
import tiktoken
from compare import spark_rows, sql_rows
from fixtures import texts  # noqa: F401

import __spark_entry__ as driver
import corpus_pipeline
from wattledger.llm import secret_scan
from wattledger.llm.oracle import ORACLE_SQL
from wattledger.llm.queries import QUERIES


def rows_of(spark, sf_dir, name, *columns):
    rows = driver.queries()[name](spark, sf_dir).select(*columns).collect()
    return sorted((tuple(row) for row in rows), key=repr)


@pytest.fixture(scope="module")
def encoding():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def test_all_registered():
    assert set(QUERIES) | {"pipeline"} <= set(driver.queries())
    assert [f"op{n}_" for n in range(1, 14)] == sorted(
        (name[: name.index("_") + 1] for name in QUERIES), key=lambda n: int(n[2:-1])
    )


@pytest.mark.parametrize("name", ORACLE_SQL)
def test_query_matches_sql(spark, sf_dir, name):
    names, rows = spark_rows(QUERIES[name](spark, sf_dir))
    sql_names, expected = sql_rows(sf_dir, ORACLE_SQL[name])
    assert names == sql_names
    assert rows and rows == expected


def test_substring_dedup(spark, sf_dir, texts):
    got = rows_of(
        spark, sf_dir, "op1_substring_dedup", "doc_id", "n_words", "n_removed", "kept_sha256"
    )
    assert got == reference.kept_words(texts)
    assert sum(row[2] for row in got) > 0


def test_near_dedup(spark, sf_dir, texts):
    got = rows_of(spark, sf_dir, "op5_near_dedup", "doc_id", "n_shingles", "component_id", "kept")
    assert got == reference.components(texts)
    assert any(not row[3] for row in got)


def test_secret_scan(spark, sf_dir, texts):
    rows = driver.queries()["op4_secret_scan"](spark, sf_dir).collect()
    by_id = {row["doc_id"]: row for row in rows}
    assert len(by_id) == len(texts)
    for doc_id, text in texts:
        base, row = reference.base_spans(text), by_id[doc_id]
        assert row["base_sha256"] == reference.sha(",".join(base))
        assert row["n_assign"] == sum(s.startswith("assign") for s in base)
        assert row["n_hex"] == sum(s.startswith("hex") for s in base)
        assert row["n_access"] == sum(s.startswith("access") for s in base)
        assert set(base) <= set(row["spans"].split(",")) | {""}


def test_packing(spark, sf_dir, texts, encoding):
    rows = driver.queries()["op7_best_fit_packing"](spark, sf_dir).collect()
    by_id, sequences = defaultdict(list), defaultdict(list)
    for row in rows:
        by_id[row["doc_id"]].append(
            (row["piece"], row["start"], row["length"], row["ids_crc32"])
        )
        sequences[row["sequence_id"]].append((row["offset"], row["length"]))
    for doc_id, text in texts:
        ids = encoding.encode_ordinary(text or "") + [2]
        assert sorted(by_id.pop(doc_id)) == reference.pieces(ids, 1024)
    assert not by_id
    for held in sequences.values():
        end = 0
        for offset, length in sorted(held):
            assert offset == end
            end += length
        assert end <= 1024
    total = sum(row["length"] for row in rows)
    assert len(sequences) <= -(-total // 1024) * 1.02 + 1


def test_bpe_codec(spark, sf_dir, texts, encoding):
    got = rows_of(
        spark, sf_dir, "op9_bpe_codec", "doc_id", "n_tokens", "ids_sha256", "decoded_sha256"
    )
    expected = []
    for doc_id, text in texts:
        ids = encoding.encode_ordinary(text or "")
        digest = reference.sha(np.array(ids, "<u4").tobytes())
        expected.append((doc_id, len(ids), digest, reference.sha(text or "")))
    assert got == sorted(expected, key=repr)


def test_toxicity_on_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.1"
    rows = driver.queries()["op10_toxicity"](spark, sf_dir).collect()
    labels = pq.read_table(f"{sf_dir}/labels.parquet").to_pydict()
    toxic = dict(zip(labels["doc_id"], labels["toxic"]))
    for row in rows:
        assert row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 5 == 0)
        assert 0 <= row["score"] <= 1 and row["predicted"] == int(row["score"] >= 0.5)
    judged = [r for r in rows if r["held_out"] and r["doc_id"] in toxic]
    hits = sum(r["predicted"] and toxic[r["doc_id"]] for r in judged)
    assert hits >= 0.8 * sum(toxic[r["doc_id"]] for r in judged)
    assert hits >= 0.95 * sum(r["predicted"] for r in judged)


def test_pipeline(spark, sf_dir):
    """Each stage against a plain version of itself, on its own input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    kept = dict(corpus_pipeline.STAGES)
    assert list(kept) == ["toxicity", "near_dedup", "substring_dedup", "secret_scan", "packing"]
    before = {row["doc_id"]: row for row in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        if name == "packing":
            break
        assert out.columns == columns
        rows = {row["doc_id"]: row for row in out.collect()}
        texts = [(d, row["text"]) for d, row in before.items()]
        if name == "toxicity":
            assert 0.8 * len(before) < len(rows) < len(before)
            assert all(before[d] == row for d, row in rows.items())
        elif name == "near_dedup":
            assert set(rows) == {row[0] for row in reference.components(texts) if row[3]}
            assert all(before[d] == row for d, row in rows.items())
        elif name == "substring_dedup":
            for doc_id, _, removed, kept_sha in reference.kept_words(texts):
                text = rows[doc_id]["text"]
                assert reference.sha(" ".join(reference.words(text))) == kept_sha
                assert removed or text == before[doc_id]["text"]
                assert rows[doc_id]["n_chars"] == len(text)
        else:
            for doc_id, text in texts:
                spans = reference.base_spans(text)
                assert ("[SECRET]" in rows[doc_id]["text"]) >= bool(spans)
                assert not secret_scan.base_spans(rows[doc_id]["text"])
                if "[SECRET]" not in rows[doc_id]["text"]:
                    assert rows[doc_id] == before[doc_id]
        before, docs = rows, spark.createDataFrame(list(rows.values()), docs.schema)
    assert {row["doc_id"] for row in out.collect()} == set(before)
