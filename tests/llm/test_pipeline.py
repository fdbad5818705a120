"""The pipeline, stage by stage, against brute force; the entry point with and without it."""

import hashlib
import os
import re
import shutil
import subprocess
import sys

import numpy as np
import pyarrow as pa
import public_tokenizers
from test_chat_mix_quality import expected_mix
from test_dedup import joined, shingles
from tokenizers import Tokenizer

import corpus_pipeline
from featlab.llm import line_crf, mixing

REPO = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))
SF = "/root/testdata/sf0.001"


def test_run_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    model = line_crf.train(docs, labels)
    good = {k: r for k, r in rows.items() if line_crf.score_texts(pa.array([r.text or ""], pa.large_string()), model)[0] >= line_crf.THRESHOLD}
    first = {}
    for k in sorted(good):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", good[k].text or ""), k)
    kept = sorted(first.values())
    sets = {k: shingles(good[k].text) for k in kept}
    comp = joined(kept, [(a, b) for a in kept for b in kept if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])])
    kept = [k for k in kept if comp[k] == k]
    items = [(k, "odd" if re.search("[13579]$", good[k].source or "") else "even", good[k].lang or "", good[k].source or "",
              len(re.findall(r"[^\x20\x09-\x0D]+", good[k].text or ""))) for k in kept]
    kept = {r[0] for r in expected_mix(items, mixing.ONCE)}
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = corpus_pipeline.run(spark, SF).collect()
    assert 0 < len(kept) < len(rows) and sorted(r.doc_id for r in got) == sorted(kept)
    for r in got:
        ids = np.asarray(t.encode(rows[r.doc_id].text, add_special_tokens=False).ids, "<u4")
        assert bytes(r.ids) == ids.tobytes() and r.n_tokens == len(ids)
        assert r.decoded_sha256 == hashlib.sha256(rows[r.doc_id].text.encode()).hexdigest()


def test_stages_take_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    odd = [(None, "no id " * 8, "en", "src1", 1), (1, None, None, None, None), (2, "", "en", "src2", 0), (3, "A fine line of words.\nAnd one more.", "en", "src1", 9),
           (3, "A fine line of words.\nAnd one more.", "en", "src1", 9), (4, "y" * 30_000, "de", None, 30_000)]
    for rows in (odd, []):
        docs = spark.createDataFrame(rows, schema)
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            if name != "tokens":
                assert out.columns == docs.columns
            assert out.count() <= len(rows)


def test_repeated_ids_lose_no_text(spark):
    """A row repeated with its id leaves one; another text under a copy's id stays, up to the mixture."""
    line = " ".join(f"word{k} of the text" for k in range(30)) + "."
    other = " ".join(f"another{k} sentence here" for k in range(30)) + "."
    rows = [(1, line), (2, line), (2, other), (2, other), (3, line + " And a tail.")]
    docs = spark.createDataFrame([(k, t, "en", "src1", len(t)) for k, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    once = corpus_pipeline.exact(spark, docs, SF)
    assert sorted((r.doc_id, r.text) for r in once.collect()) == sorted({(1, line), (2, other), (3, line + " And a tail.")})
    near = corpus_pipeline.near(spark, docs, SF)
    assert sorted({(r.doc_id, r.text) for r in near.collect()}) == sorted({(1, line), (2, other)})


def test_entry_point_without_the_subpackage(tmp_path):
    """The rest of the library imports and lists its queries when the llm files are gone."""
    shutil.copytree(REPO, tmp_path / "r", ignore=shutil.ignore_patterns("llm", "corpus_pipeline.py", ".git", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not any(k.startswith('op') and k[2].isdigit() for k in q) and 'pipeline' not in q; print(len(q), len(e.oracle_sql()))"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "r", env=env, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr[-800:]


def test_queries_are_registered():
    sys.path.insert(0, REPO)
    import __spark_entry__ as entry
    names = entry.queries()
    assert all(any(k.startswith(f"op{n}_") for k in names) for n in range(1, 14)) and "pipeline" in names
    assert {"op1_mix_sources", "op2_near_vectors", "op4_chat_format", "op5_exact_dedup", "op12_son_collocations"} <= set(entry.oracle_sql())
