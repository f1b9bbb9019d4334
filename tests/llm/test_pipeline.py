"""The pipeline, stage by stage, against what each stage promises on its own input."""

from __future__ import annotations

import re

import corpus_pipeline
import __spark_entry__ as entry
from sparktape.llm import decontaminate, line_dedup, toxicity
from sparktape.llm.tables import materialise, read_table


def test_stages_keep_their_promises(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    columns, before, sizes = docs.columns, docs, {}
    for name, stage in corpus_pipeline.STAGES:
        after = materialise(stage(spark, before, sf_dir), "test-stage")
        if name != "packing":
            assert after.columns == columns
        old = {r.doc_id: r.text for r in before.select("doc_id", "text").collect()}
        new = {r.doc_id: r.text for r in after.select("doc_id", "text").collect()} if "text" in after.columns else {}
        sizes[name] = (len(old), len(new))
        if name == "toxicity":
            insult = re.compile("idiot|scum|moron|loser|trash|clown|stupid")
            clean = [d for d, t in old.items() if not insult.search(t.lower())]
            assert sum(d in new for d in clean) > 0.9 * len(clean)
        if name == "line_dedup":
            seen = [x for t in new.values() for x in set(line_dedup.normal_lines(t)) if x]
            assert len(seen) == len(set(seen))
            assert all(set(t.split("\n")) <= set(old[d].split("\n")) for d, t in new.items())
        if name == "near_dedup":
            assert set(new) <= set(old) and all(new[d] == old[d] for d in new)
        if name == "decontaminate":
            left = decontaminate.contamination(after, read_table(spark, sf_dir, "benchmark")).collect()
            assert all(20 * r.n_hit < max(1, r.n_words) for r in left)
        if name == "packing":
            assert {r.doc_id for r in after.collect()} == set(old)
        before = after
    assert toxicity.TOXIC_AT == 0.7
    assert sizes["toxicity"][1] > 0.7 * sizes["toxicity"][0]


def test_registered():
    assert entry.queries()["pipeline"] is corpus_pipeline.run
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "decontaminate", "packing"]
