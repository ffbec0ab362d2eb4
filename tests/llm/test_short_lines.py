"""Short lines that many sites share go in the pipeline like longer ones."""

import corpus_pipeline

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_short_shared_lines_go_but_the_first(spark):
    rows = [(i, f"own text {i}\nMenu\n版权所有\n\nrare", "en", f"s{i % 9}" if i < 18 else "s0", 0) for i in range(30)]
    rows += [(40 + i, "Few", "en", f"s{i}", 0) for i in range(7)]
    out = corpus_pipeline.drop_shared_lines(spark, spark.createDataFrame(rows, SCHEMA), None).collect()
    texts = {r.doc_id: r.text for r in out}
    assert texts[0] == "own text 0\nMenu\n版权所有\n\nrare"
    assert all(texts[i] == f"own text {i}\n" for i in range(1, 30))
    assert all(texts[40 + i] == "Few" for i in range(7))
    assert all(r.n_chars == len(r.text) for r in out)
