"""Each stage against the operator it calls, and the run as a whole."""

import corpus_pipeline as cp
from fleetbook.llm import mixing, neardup, quality, tiling, wavelet
from fleetbook.llm.common import read
from fleetbook.llm.queries import MIX_FRACTION, MIX_POWERS, MIX_SEED

SF = "/root/testdata/sf0.001"


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_stages(spark):
    docs = read(spark, SF, "documents")
    stages = dict(cp.STAGES)
    assert list(stages) == ["quality", "near_duplicates", "decontaminate", "mix", "token_shards"]
    out = {}
    for name in list(stages)[:-1]:
        out[name] = stages[name](spark, docs, SF)
        assert out[name].columns == docs.columns
    assert ids(out["quality"]) == ids(quality.classify(docs).where("kept"))
    assert ids(out["near_duplicates"]) == ids(neardup.near_duplicates(docs).where("kept"))
    gone = {r.doc_id for r in tiling.contaminated(docs, read(spark, SF, "benchmark")).collect()}
    assert gone and ids(out["decontaminate"]) == sorted(set(ids(docs)) - gone)
    assert ids(out["mix"]) == ids(mixing.mix(docs, MIX_POWERS, MIX_FRACTION, MIX_SEED).where("sampled"))
    assert ids(stages["token_shards"](spark, docs, SF)) == ids(docs)


def test_run_is_the_stages_in_turn(spark):
    docs = read(spark, SF, "documents")
    for _, stage in cp.STAGES:
        docs = stage(spark, docs, SF)
    assert sorted(map(tuple, docs.collect())) == sorted(map(tuple, cp.run(spark, SF).collect()))


def test_stages_keep_clashing_columns_and_null_ids(spark):
    schema = ("doc_id long, text string, lang string, source string, n_chars long, kept string, id string,"
              " component_id string, sampled string, topic string, probability string, n string, votes string, a string")
    prose = "Some plain words about the river and the hills beyond it, told slowly. "
    rows = [(i, f"{prose}Number {i} differs here in every place that it can.", "en", "s", 1, *"pqrstuvwx") for i in range(30)]
    rows += [(None, prose, None, None, None, *[None] * 9), (50, None, "en", "s", 1, *"pqrstuvwx")]
    docs = spark.createDataFrame(rows, schema)
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        assert all(r.kept in ("p", None) for r in out.collect())
        assert stage(spark, docs.where("false"), SF).count() == 0
    assert wavelet and cp.STAGES[-1][1](spark, docs, SF).count() == len(rows)
