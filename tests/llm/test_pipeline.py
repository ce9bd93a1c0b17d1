"""The pipeline against a plain re-statement of its stages, and the entry point's guard."""

import hashlib
import os
import subprocess
import sys

import public_tokenizers as P

import corpus_pipeline
from cardsentry.llm.quality_rules import quality_rules

from .conftest import words
from .test_near_dup import brute as near_brute
from .test_repeats import brute as repeat_brute
from .test_tokens import RANKS, digest, library  # noqa: F401

SF = "/root/testdata/sf0.001"


def cut(text, spans):
    """Text without the words of the spans and what stands between them."""
    import re

    at = [m.span() for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
    out, left = [], 0
    for a, b in spans:
        out.append(text[left:at[a][0]])
        left = at[b - 1][1]
    return "".join(out) + text[left:]


def test_run_matches_brute_force(spark, library):  # noqa: F811
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {r.doc_id for r in quality_rules(docs).where("kept").collect()}
    rows = {r.doc_id: r.text for r in docs.collect() if r.doc_id in kept}
    stay = {d for d, _, c in near_brute(sorted(rows.items()), 5, 80) if d == c}
    rows = {d: t for d, t in rows.items() if d in stay}
    spans = repeat_brute(rows.items(), 50)
    rows = {d: cut(t, spans[d]) if d in spans else t for d, t in rows.items()}
    items = [words(r.text.lower()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    whole = {tuple(i) for i in items}
    rows = {d: t for d, t in rows.items() if not any(tuple(w[k:k + len(i)]) in whole for w in [words(t.lower())] for i in items for k in range(len(w) - len(i) + 1))}
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert set(got) == set(rows)
    for d, t in rows.items():
        assert got[d].ids_sha256 == digest(library.encode_ordinary(t))
        assert got[d].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()
    assert RANKS == P.path("byte_bpe_50k.tiktoken")


def test_all_but_the_last_stage_keep_the_columns(spark, make_docs):
    docs = make_docs([])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns


def test_entry_point_without_this_folder(tmp_path):
    """The other queries are there when the folder and the pipeline are not."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    for name in os.listdir(root):
        if name not in ("corpus_pipeline.py", "cardsentry", ".git", "tests"):
            os.symlink(f"{root}/{name}", tmp_path / name)
    (tmp_path / "cardsentry").mkdir()
    for name in os.listdir(f"{root}/cardsentry"):
        if name not in ("llm", "__pycache__"):
            os.symlink(f"{root}/cardsentry/{name}", tmp_path / "cardsentry" / name)
    code = "import __spark_entry__ as e; q = e.queries(); assert q and set(e.oracle_sql()) <= set(q); assert not any(k.startswith('op') or k == 'pipeline' for k in q)"
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=tmp_path, env={**os.environ, "PYTHONPATH": str(tmp_path)})
    assert done.returncode == 0, done.stderr
