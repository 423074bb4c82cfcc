import pytest
from tokenizers import Tokenizer

import corpus_pipeline as P
from millrace.llm import tokens
from tests.conftest import SF
from tests.llm.test_decontamination import brute as brute_near
from tests.llm.test_rules import brute_kept, brute_lines
from tests.llm.test_simhash import brute_components, brute_fingerprint
from tests.llm.test_tokens import check_places


def test_pipeline_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    kept, _ = brute_kept([(d, r.text, r.lang, r.source) for d, r in rows.items()])
    ids = sorted(d for d in rows if kept[d])
    texts = {d: t for d, (t, _) in zip(ids, brute_lines([(d, rows[d].text) for d in ids], 2))}
    ids = [d for d, _, c in brute_components([(d, brute_fingerprint(texts[d])) for d in ids]) if d == c]
    near = brute_near([(d, texts[d]) for d in ids], [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()])
    ids = [d for d in ids if not near[d]]
    tok = Tokenizer.from_file(tokens.default_tokenizer())
    got = P.run(spark, SF).collect()
    check_places(got, {d: tok.encode(texts[d], add_special_tokens=False).ids + [0] for d in ids})
    assert 0 < len(ids) < len(rows)


@pytest.mark.parametrize("name,stage", P.STAGES)
def test_stages_take_empty_and_odd_tables(spark, name, stage):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", None, 0), (1, "", "en", None, 0)], docs.schema)
    out = stage(spark, odd, SF)
    out.collect()
    if name != "pack":
        assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
    assert stage(spark, docs.limit(0), SF).count() == 0
