"""The pipeline's rows against plain versions of its stages."""

import hashlib

import sentencepiece
from test_exact_dedup import LOWER
from test_simhash_dedup import plain_components, plain_fingerprint

import corpus_pipeline
from tallywork.llm import noisy_channel, source_mix
from tallywork.llm.piece_transducer import MODEL
from tallywork.llm.text import table

SMALL = "/root/testdata/sf0.01"


def test_rows(spark):
    docs = table(spark, SMALL, "documents")
    data = {r.doc_id: r.text for r in docs.collect()}
    scores = noisy_channel.toxicity(docs, table(spark, SMALL, "labels")).collect()
    kept = [r.doc_id for r in scores if not r.predicted]
    assert 0 < len(kept) < len(data)
    largest = {}
    for i in kept:
        largest[data[i].translate(LOWER)] = max(i, largest.get(data[i].translate(LOWER), i))
    kept = sorted(largest.values())
    prints = [(i, plain_fingerprint(data[i])) for i in kept]
    kept = [i for i, c in zip(kept, plain_components(prints), strict=True) if i == c]
    left = docs.filter(docs.doc_id.isin(kept))
    taken = {r.doc_id: r.taken for r in source_mix.mix_sources(left).collect()}
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    out = corpus_pipeline.run(spark, SMALL).collect()
    words = dict.fromkeys(kept, 0)
    for r in out:
        text = library.decode(list(r.ids))
        words[r.doc_id] += len(text.encode().split())
        assert list(r.ids) == library.encode(text) and r.round_trip
        assert hashlib.sha256(text.encode()).hexdigest() == r.decoded_sha256
    assert words == taken


def test_stages_keep_the_columns(spark):
    docs = table(spark, SMALL, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.schema.simpleString() == docs.schema.simpleString()
    assert corpus_pipeline.ORACLE_SQL is None and len(corpus_pipeline.STAGES) == 5


def test_no_documents(spark):
    docs = table(spark, SMALL, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SMALL).count() == 0


def test_rows_without_an_id_of_their_own(spark):
    """Of equal rows one stays; other rows with their id, or with none, lose nothing by it."""
    text = lambda k: " ".join(f"w{k}x{j}" for j in range(70))
    data = [(None, text(0)), (None, text(1)), (None, text(1)), (5, text(2)), (5, text(2)), (5, text(3)), (6, text(4))]
    docs = table(spark, SMALL, "documents")
    made = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in data], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    made = made.select(*[made[f.name].cast(f.dataType) for f in docs.schema]).repartition(3)
    want = sorted({(i or -1, t) for i, t in data})
    for stage in (corpus_pipeline.exact, corpus_pipeline.near):
        made = stage(spark, made, SMALL)
        assert sorted((r.doc_id or -1, r.text) for r in made.collect()) == want
    # One source of 5 blocks of 70 words: 1.5 times, to a block, no document more than twice.
    taken = {}
    for r in corpus_pipeline.mix(spark, made, SMALL).collect():
        taken.setdefault((r.doc_id or -1, r.text.split()[0].split("x")[0]), []).append(len(r.text.split()))
    assert sum(map(sum, taken.values())) == 8 * 70
    assert {k[0] for k in taken} == {-1, 5, 6} and len(taken) == len(want) and all(max(v) <= 70 and len(v) <= 2 for v in taken.values())
