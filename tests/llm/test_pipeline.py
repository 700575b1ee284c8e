"""The pipeline's stages on small tables, each against plain Python on what the stage before has kept."""

import random
import zlib

import numpy as np
from test_jaccard_join import brute
from test_row_operators import brute_leaks

import corpus_pipeline
from tidewright.llm import mixing, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_tokens int, label int"
BAD = ["zlorqua", "zlorqui", "zlorquo", "zlorque"]


def tables(folder, spark):
    rng = random.Random(8)
    part = lambda: "".join(rng.choice(["an", "er", "in", "ou", "re", "st", "th"]) for _ in range(rng.randrange(2, 5)))
    words = [part() for _ in range(800)]
    passage = [f"quiz{i}" for i in range(16)]
    docs, labels = [], []
    for i in range(240):
        text, toxic = [rng.choice(words) for _ in range(40)], i % 4 == 0
        if toxic:
            for _ in range(5):
                text[rng.randrange(len(text))] = rng.choice(BAD)
        elif i % 10 == 1:
            text[5:5] = passage
        elif i % 10 == 3 and docs:
            text = docs[-1][1].split()
            text[0] = "changed"
        docs.append((i, " ".join(text), rng.choice(["en", "de", None]), "hot" if i % 3 == 0 else f"s{i % 5}", 0, 0))
        labels.append((i, 1, int(toxic)))
    docs += [(240, None, None, None, None, None), (241, "", "en", "hot", 0, 0), docs[5]]
    for name, rows, schema in (
        ("documents", docs, DOCS),
        ("labels", labels, "doc_id long, quality int, toxic int"),
        ("benchmark", [(0, " ".join(passage)), (1, None), (2, "")], "item_id long, text string"),
    ):
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return docs


def test_every_stage(spark, tmp_path):
    from tokenizers import Tokenizer

    from tidewright.llm.queries import vocabulary

    folder = str(tmp_path)
    docs = tables(folder, spark)
    stages = dict(corpus_pipeline.STAGES)
    rows = lambda df: sorted((tuple(r) for r in df.collect()), key=str)
    frame = spark.createDataFrame(docs, DOCS)
    order = lambda x: sorted(x, key=str)

    clean = stages["toxicity"](spark, frame, folder)
    verdicts = {(r.doc_id): r.predicted for r in toxicity.score(frame, spark.read.parquet(f"{folder}/labels.parquet")).collect()}
    kept = rows(clean)
    assert clean.columns == frame.columns and kept == order(d for d in docs if not verdicts[d[0]])
    truth = {d[0]: any(b in (d[1] or "") for b in BAD) for d in docs}
    assert sum(verdicts[i] == truth[i] for i in truth) >= 0.97 * len(truth)

    frame = spark.createDataFrame(kept, DOCS)
    single = rows(stages["ngram_jaccard_join"](spark, frame, folder))
    classes = {x[2] for x in brute(kept) if x[1].split()}
    assert {str(r[0]) for r in single if (r[1] or "").split()} == classes and len(single) < len(kept)
    assert set(single) <= set(kept)

    frame = spark.createDataFrame(single, DOCS)
    unseen = rows(stages["decontamination"](spark, frame, folder))
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    leaking = {d for d, _ in brute_leaks([(r[0], r[1]) for r in single], items)}
    assert unseen == order(r for r in single if r[0] not in leaking) and len(unseen) < len(single)

    frame = spark.createDataFrame(unseen, DOCS)
    mixture = rows(stages["mixing"](spark, frame, folder))
    sampled = {r.doc_id for r in mixing.mix(frame).collect() if r.sampled}
    assert mixture == order(r for r in unseen if r[0] in sampled) and mixture

    tokenizer = Tokenizer.from_file(vocabulary())
    got = sorted(tuple(r) for r in corpus_pipeline.run(spark, folder).select("doc_id", "start", "n_tokens", "ids_crc32").collect())
    want, start = [], 0
    for r in sorted(mixture, key=lambda r: r[0]):
        ids = np.array(tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [2], "<u4")
        want.append((r[0], start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert got == want
