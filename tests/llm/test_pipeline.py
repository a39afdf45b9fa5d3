import random

import pytest

import corpus_pipeline as C
from recfold.llm import decontaminate, mixing, pii, simhash, toxicity

INSULTS = ["blockhead", "dimwit", "numskull"]
PASSAGE = "what is the tallest mountain on the dark side of the moon and who climbed it first"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(0)
    syll = ["ba", "ko", "ri", "tu", "men", "sal", "po", "ne"]
    word = lambda: "".join(rng.choices(syll, k=rng.randint(1, 5)))
    docs, labels = [], []
    for i in range(240):
        w = [word() for _ in range(rng.randint(60, 120))]
        if i % 6 == 0:
            for _ in range(5):
                w.insert(rng.randrange(len(w)), rng.choice(INSULTS) + ".")
        docs.append([i, " ".join(w), rng.choice(["en", "de"]), f"src{i % 4}"])
        labels.append((i, 0, int(i % 6 == 0)))
    clean = [d for d in docs if d[0] % 6]
    for j in range(10):
        docs.append([1000 + j, clean[j][1], "en", "src1"])                      # exact copies
        docs.append([1100 + j, clean[20 + j][1] + " " + PASSAGE, "en", "src2"])   # leaks
    clean[50][1] += " mail jane.roe7@mail3.example.com"
    docs += [[2000, None, None, None], [2001, "", "en", "src0"]]
    d = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame([(i, t, l, s, len(t or "")) for i, t, l, s in docs],
                          "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, PASSAGE)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d


def test_stages_in_order():
    assert [f for _, f in C.STAGES] == [C.drop_toxic, C.drop_near_duplicates, C.drop_contaminated, C.replace_personal_data, C.mix_sources]


def test_each_stage_works_on_what_the_one_before_kept(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = docs.columns
    kept = [docs]
    for k, (name, stage) in enumerate(C.STAGES):
        out = stage(spark, kept[-1], folder)
        assert k == len(C.STAGES) - 1 or out.columns == names
        out.write.parquet(f"{tmp_path}/{k}")
        kept.append(spark.read.parquet(f"{tmp_path}/{k}"))
    start, clean, single, safe, private, mixed = kept
    ids = [{r["doc_id"] for r in x.select("doc_id").collect()} for x in kept]
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    toxic = {r["doc_id"] for r in labels.filter("toxic = 1").collect()}
    rejected = ids[0] - ids[1]
    assert len(rejected & toxic) >= 0.9 * len(toxic) and len(rejected - toxic) <= 3
    # one row of every component of the stage's own input
    roots = simhash.near_duplicates(clean).groupBy("root").agg({"component_id": "min"}).collect()
    assert single.count() == len(roots) and ids[2] == {r[1] for r in roots}
    assert not ids[2] & set(range(1000, 1010))
    hit = {r["doc_id"] for r in decontaminate.report(single, spark.read.parquet(f"{folder}/benchmark.parquet")).filter("contaminated").collect()}
    assert hit and ids[3] == ids[2] - hit and hit == set(range(1100, 1110)) & ids[2]
    moved = pii.settle(pii.entities(safe))
    want = {r["doc_id"]: None if r["text"] is None else pii.replace(r["text"], pii.KEY, moved)[0] for r in safe.collect()}
    assert {r["doc_id"]: r["text"] for r in private.collect()} == want
    assert not any("jane.roe7" in (t or "") for t in want.values())
    key = ["doc_id", "domain", "epoch", "n_tokens"]
    assert sorted(map(str, mixed.select(key).collect())) == sorted(map(str, mixing.mix(private).select(key).collect()))
    assert mixed.count() > 0 and ids[5] <= ids[4]


def test_run(spark, folder):
    out = C.run(spark, folder)
    assert {"doc_id", "text", "lang", "source", "n_chars", "epoch"} <= set(out.columns) and out.count() > 0


def test_toxicity_stage_without_labels_keeps_all(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.reject(docs, none).count() == docs.count()
