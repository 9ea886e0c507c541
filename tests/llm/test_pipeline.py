"""The pipeline's stages one by one against plain versions of their decisions."""

from __future__ import annotations

import math

import corpus_pipeline
import public_tokenizers
from tokenizers import Tokenizer

from boxmill.llm import decontaminate, quality_rules, queries, text_features

from .test_neardup import classes


def plain_grade(model, text):
    """The expected grade of a text by one loop over its features."""
    score = sum(float(model.weights[i]) * float(v) for i, v in zip(*text_features.graded_features(text, model.bits), strict=True))
    return sum(1 / (1 + math.exp(t - score)) for t in model.thresholds)


def test_stages_and_run(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names, columns = [n for n, _ in corpus_pipeline.STAGES], docs.columns
    assert names == ["quality_rules", "quality_classifier", "near_duplicates", "decontamination", "packing"]
    stage = dict(corpus_pipeline.STAGES)
    texts = {r.doc_id: r.text for r in docs.collect()}
    expected = {d for d, t in texts.items() if quality_rules.judge(t, 0.5)[6]}
    # A plain removal of lines; all later stages are followed on the changed texts.
    for d in expected:
        lines, kept = texts[d].split("\n"), []
        for i, line in enumerate(lines):
            if not line.strip() or (line not in lines[:i] and not quality_rules.failing_rule(line)):
                kept.append(line)
        texts[d] = "\n".join(kept)
    assert any(len(texts[r.doc_id]) != len(r.text) for r in docs.collect() if r.doc_id in expected)
    for name in names[:-1]:
        docs = stage[name](spark, docs, sf_dir)
        assert docs.columns == columns
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name == "quality_classifier":
            model = queries.quality_model(spark, sf_dir)
            expected = {d for d in expected if plain_grade(model, texts[d]) >= queries.LEAST_EXPECTED}
        elif name == "near_duplicates":
            found = classes([(d, texts[d]) for d in expected])
            expected = {d for d in expected if found[d][1] == d}
        elif name == "decontamination":
            items = [decontaminate.normalise(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
            held = {d for d in expected if any(i in decontaminate.normalise(texts[d]) for i in items)}
            got = {r.doc_id for r in docs.collect()}
            assert not held & got
            expected -= held
        assert {r.doc_id: (r.text, r.n_chars) for r in docs.collect()} == {d: (texts[d], len(texts[d])) for d in expected}
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    total = sum(len(tokenizer.encode(texts[d], add_special_tokens=False).ids) + 1 for d in expected)
    pieces = corpus_pipeline.run(spark, sf_dir)
    assert pieces.agg({"length": "sum"}).first()[0] == total
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == expected


def test_stages_take_odd_and_empty_tables(spark, sf_dir):
    schema = "doc_id long, text string, lang string, source string, n_chars long, kept string"
    model = queries.quality_model(spark, sf_dir)
    for rows in ([], [(1, None, None, None, None, "x"), (2, "", None, None, None, "y"), (1, "a b", None, None, None, "z")]):
        docs = spark.createDataFrame(rows, schema)
        for name, stage in corpus_pipeline.STAGES:
            left = stage(spark, docs, sf_dir)
            stay = {"quality_rules": [], "quality_classifier": [r for r in rows if plain_grade(model, r[1]) >= queries.LEAST_EXPECTED]}.get(name, rows)
            assert left.count() == len(stay)
            if name == "quality_classifier":
                assert sorted(r.kept for r in left.collect()) == sorted(r[5] for r in stay)
            assert name == "packing" or left.columns == docs.columns
