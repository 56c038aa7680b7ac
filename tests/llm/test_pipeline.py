"""The pipeline stage by stage against brute force."""

import hashlib
from collections import defaultdict

import corpus_pipeline
from concord.llm import bpe, mixing, queries, toxicity
from concord.llm.store import new_folder

from .test_simhash import brute_components, brute_fingerprint

SF01 = "/root/testdata/sf0.01"


def staged(spark, docs, sf_dir, columns):
    """(name, input rows, output rows, output frame) of every stage, written and read between."""
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before, out = docs.collect(), stage(spark, docs, sf_dir)
        if k + 1 < len(corpus_pipeline.STAGES):
            assert out.columns == columns
        path = new_folder(spark, "stage")
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        yield name, before, docs.collect(), docs


def test_stages_against_brute_force(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(queries.BYTE_BPE)
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    odd = [(10**6, None, "en", "src1", 0), (10**6 + 1, "", None, None, None), (10**6 + 1, "", None, None, None), (None, "no id here", "en", "src2", 1), (10**6 + 3, "a b " * 50000, "en", "src1", 4)]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    model = toxicity.train(docs, spark.read.parquet(f"{SF01}/labels.parquet"))
    seen = []
    for name, before, after, frame in staged(spark, docs, SF01, docs.columns):
        seen.append(name)
        if name == "toxicity":
            assert sorted(after, key=repr) == sorted((r for r in before if model.score(r.text) < 0.7), key=repr)
            assert 0 < len(after) < len(before)
        elif name == "simhash":
            ids = [r.doc_id for r in before if r.doc_id is not None]
            fps = [brute_fingerprint(r.text) for r in before if r.doc_id is not None]
            want = set(brute_components(fps, ids).values())
            assert sorted(r.doc_id for r in after if r.doc_id is not None) == sorted(want) and None in {r.doc_id for r in after}
        elif name == "mixing":
            assert sorted(after, key=repr) == sorted(before, key=repr)
            order = frame.select("doc_id", "_metadata.file_name", "_metadata.row_index").collect()
            order = [r[0] for r in sorted(order, key=lambda r: (r[1][:10], r[2]))]
            placed = mixing.mix(spark.createDataFrame(before, docs.schema)).collect()
            assert order == [r.doc_id for r in sorted(placed, key=lambda r: (r.mix_slot, r.mix_offset))]
            by = defaultdict(set)
            for r in placed:
                by[r.source].add(r.mix_slot)
            assert all(a.isdisjoint(b) for s, a in by.items() for t, b in by.items() if s != t)
        else:
            assert len(after) == len(before)
            texts = {r.doc_id: r.text or "" for r in before}
            for r in after:
                assert r.ids == library.encode(texts[r.doc_id], add_special_tokens=False).ids and r.n_tokens == len(r.ids)
                assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest() and r.mix_file and r.mix_row is not None
    assert seen == ["toxicity", "simhash", "mixing", "bpe"]


def test_run_equals_the_stages_and_takes_empty_tables(spark):
    got = corpus_pipeline.run(spark, SF01)
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    *_, (_, _, last, _) = staged(spark, docs, SF01, docs.columns)
    strip = lambda rows: sorted(((r.doc_id, r.decoded_sha256, r.n_tokens) for r in rows), key=repr)
    assert strip(got.collect()) == strip(last)
    for _, _, rows, _ in staged(spark, docs.limit(0), SF01, docs.columns):
        assert rows == []


def test_columns_of_any_name_and_repeated_ids_pass(spark):
    names = ["__toxicity", "toxicity", "__kept", "__source", "mix_slot", "mix_offset", "mix_slot_"]
    rows = [(1, f"words {'abc '[k % 3]} {k}" * 9, "en", "s", 3, *range(7)) for k in range(6)] + [(1, "words a 0" * 9, "en", "s", 3, *range(7))]
    df = spark.createDataFrame(rows, ["doc_id", "text", "lang", "source", "n_chars", *names])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, df, SF01)
        assert out.columns == df.columns, name
        got = out.collect()
        assert {tuple(r[5:]) for r in got} == {tuple(range(7))} and len(got) >= 1
        texts = {r.text for r in df.collect()}
        assert {r.text for r in got} <= texts
        if name == "mixing":
            assert sorted(map(tuple, got)) == sorted(rows)
        if name == "simhash":
            fps = {t: brute_fingerprint(t) for t in texts}
            kept = brute_components(list(fps.values()), list(range(len(fps))))
            assert len(got) == len(set(kept.values()))


def test_stage_input_that_is_no_file(spark):
    df = spark.createDataFrame([(1, "a b", "en", "s", 3, "x")], "doc_id long, text string, lang string, source string, n_chars long, mix_row string")
    got = corpus_pipeline.tokenize(spark, df, SF01).collect()
    assert [(r.doc_id, r.mix_file, r.mix_row, r.n_tokens) for r in got] == [(1, None, None, 2)]
    assert bpe.Decoder(bpe.read_vocabulary(queries.BYTE_BPE)).decode(got[0].ids) == "a b"
