"""The pipeline against a plain version of its stages on a small table."""

import re

import corpus_pipeline
from test_simhash import plain_components

from tollstream.llm import quality, simhash
from tollstream.llm.pii import ANY
from tollstream.llm.shared import stage, table
from tollstream.llm.tokens import encoder, tokenizer_path

SF = "/root/testdata/sf0.001"


def test_stages_against_plain_versions(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    kept = {}
    before = docs
    for name, step in corpus_pipeline.STAGES:
        docs = stage(step(spark, docs, SF), name)
        if name != "packing":
            assert docs.columns == columns and docs.schema.simpleString() == before.schema.simpleString()
            kept[name] = {r["doc_id"]: r for r in docs.collect()}
            assert len(kept[name]) == docs.count()
    every = {r["doc_id"]: r["text"] for r in before.collect()}

    model = quality.fit(before, table(spark, SF, "labels"))
    ids = sorted(every)
    scores = model.score(__import__("numpy").array([quality.statistics(every[i]) for i in ids]))
    want = {i for i, s in zip(ids, scores) if s >= 0.3}
    assert set(kept["quality"]) == want

    prints = {i: simhash.fingerprint(every[i]) for i in want}
    root = plain_components(sorted(set(prints.values())), 2)
    first = {}
    for i in sorted(want):
        first.setdefault(root[prints[i]], i)
    assert set(kept["near_dedup"]) == set(first.values())

    plain = lambda t: " ".join(re.findall(r"\w+", t.lower()))
    items = [plain(r["text"]) for r in table(spark, SF, "benchmark").collect()]
    clean = {i for i in first.values() if not any(b in plain(every[i]) for b in items)}
    assert set(kept["decontamination"]) == clean

    assert set(kept["pii"]) == clean
    private = re.compile(r"[\w.+-]+@[\w-]+\.[\w.]+\w|\+\d \(\d+\) [\d-]+|\b(?:\d{1,3}\.){3}\d{1,3}\b|\b\d{16}\b|\b[0-9a-f]{40}\b")
    for i in clean:
        new, found = kept["pii"][i]["text"], private.findall(every[i])
        assert not any(v in new for v in found)
        assert found or new == every[i]
        assert kept["pii"][i]["n_chars"] == len(new)
        assert len(private.findall(new)) == len(found)

    enc = encoder(tokenizer_path("byte_bpe_50k.json"), "byte")
    rows = docs.collect()
    for i in clean:
        assert sum(r["length"] for r in rows if r["doc_id"] == i) == len(enc.ids([kept["pii"][i]["text"]])[0]) // 4 + 1
    fill = {}
    for r in rows:
        fill[r["sequence_id"]] = fill.get(r["sequence_id"], 0) + r["length"]
    assert max(fill.values()) <= 2048 and len(fill) <= sum(fill.values()) / 2048 * 1.05 + 1
    assert ANY


def test_registered_with_its_stages(spark):
    import __spark_entry__ as entry

    assert entry.queries()["pipeline"] is corpus_pipeline.run
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "decontamination", "pii", "packing"]
    ops = {int(re.match(r"op(\d+)_", k)[1]) for k in entry.queries() if re.match(r"op\d+_", k)}
    assert ops == set(range(1, 14))
    assert corpus_pipeline.run(spark, SF).count() > 0


def test_odd_tables(spark):
    """Nulls, repeats, clashing names and no rows through every stage."""
    from llm_helpers import edge_docs, no_docs

    for docs in (edge_docs(spark), no_docs(spark)):
        for name, step in corpus_pipeline.STAGES:
            out = step(spark, docs, SF)
            assert out.count() <= docs.count() + 100
            if name != "packing":
                assert out.columns == docs.columns
                docs = stage(out, name)
