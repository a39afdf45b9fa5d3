import random

import pyarrow as pa
import pytest

from recfold.llm import toxicity as X

INSULTS = ["blockhead", "dimwit", "numskull"]


def kernel(a, b):
    """Common three-letter subsequences over all index triples, by definition."""
    def vec(w):
        w = X._BEGIN + w + X._END
        d = {}
        for i in range(len(w)):
            for j in range(i + 1, len(w)):
                for k in range(j + 1, len(w)):
                    if k - i < X.SPAN:
                        g = w[i] + w[j] + w[k]
                        d[g] = d.get(g, 0) + X.DECAY ** (k - i + 1)
        return d
    u, v = vec(a), vec(b)
    dot = lambda x, y: sum(c * y.get(g, 0) for g, c in x.items())
    return dot(u, v) / (dot(u, u) * dot(v, v)) ** .5


def test_kernel_equals_its_definition():
    marks = X.Landmarks(["blockhead", "dimwit", "ünter", "aaaa"])
    words = ["blockhead", "bl-ockh.ead", "dimwits", "d1mwit", "unter", "ünterr", "aaaaaa", "the", "xyz", "dim", "headblock"]
    w, l, v = marks.kernel(words)
    got = {(words[i], marks.words[j]): x for i, j, x in zip(w, l, v)}
    for a in words:
        for b in marks.words:
            want = kernel(a, b)
            if want >= X.FLOOR + 1e-9:
                assert got[a, b] == pytest.approx(min(want, 1.0), abs=1e-9)
            elif want < X.FLOOR - 1e-9:
                assert (a, b) not in got
    assert marks.matrix() == pytest.approx(pytest.importorskip("numpy").array([[kernel(a, b) for b in marks.words] for a in marks.words]))


def corpus(n=400, seed=0):
    rng = random.Random(seed)
    syll = ["ba", "ko", "ri", "tu", "men", "sal", "po", "ne"]
    docs, labels = [], []
    for i in range(n):
        w = ["".join(rng.choices(syll, k=rng.randint(1, 4))) for _ in range(rng.randint(20, 80))]
        toxic = int(i % 5 == 0)
        for _ in range(3 * toxic):
            w.insert(rng.randrange(len(w)), rng.choice(INSULTS))
        docs.append((i, " ".join(w) + "."))
        labels.append((i, 0, toxic))
    return docs, labels


def test_held_out_accuracy_gaps_and_edge_cases(spark):
    docs, labels = corpus()
    odd = [(1001, "you d i m w i t you n u m s k u l l."), (1002, "what a num-skull, dim.wit and block-head."), (1003, None), (1004, ""),
           (1005, "bakori " * 30_000), (1006, "bakori " * 2_000 + "dimwit numskull blockhead " * 60), (5, docs[5][1]), (None, docs[5][1]), (1007, "x" * 100_000)]
    d = spark.createDataFrame([(i, t, 0.5) for i, t in docs + odd], "doc_id long, text string, score double").repartition(3)
    l = spark.createDataFrame(labels + [(2, 0, None), (None, 0, 1), (9999, 0, 1)], "doc_id long, quality int, toxic int")
    rows = X.report(d, l).collect()
    assert len(rows) == len(docs) + len(odd)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= .5) for r in rows)
    truth = {i: t for i, _, t in labels}
    held = [r for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert len(held) > 40 and sum(r["predicted"] == truth[r["doc_id"]] for r in held) / len(held) >= 0.97
    by = {r["doc_id"]: r["predicted"] for r in rows}
    assert by[1001] == by[1002] == by[1006] == 1 and by[1003] == by[1004] == by[1005] == by[1007] == 0
    kept = X.reject(d, l)
    assert kept.columns == d.columns and {r["doc_id"] for r in kept.collect()} == {i for i, p in by.items() if not p}


def test_no_labels_and_empty(spark):
    d = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r["score"] for r in X.report(d, none).collect()] == [0.0, 0.0]
    assert X.report(d.limit(0), none).collect() == []


def test_texts_without_words():
    row, x, n = X.sentence_vectors(pa.array(["", " ", "..."]), X.Landmarks(["dimwit"]))
    assert len(row) == 0 and n.tolist() == [0, 0, 1]


def test_gapped_and_embedded_words_count_as_the_word():
    marks = X.Landmarks(["idiot", "blockhead"])
    gapped = ["i.d.i.o.t", "i-d-i-o-t", "so i_d_i_o_t!", "i - d - i - o - t", "i. d. i. o. t.", "youareanidiot", "zqidiotzq", "qqq" * 40 + "idiot" + "zz" * 40]
    row, x, _ = X.sentence_vectors(pa.array(gapped), marks)
    best = [max(x[row == i, 0], default=0) for i in range(len(gapped))]
    assert best == pytest.approx([1.0] * len(gapped))
    row, x, _ = X.sentence_vectors(pa.array(["a good day - and a.n.d", "classification"]), marks)
    assert len(row) == 0


def test_windows_equal_their_definition():
    marks = X.Landmarks(["blockhead", "dimwit", "idiot", "aaaa"])
    words = ["youdimwits", "xblckheadx", "aaaaaaa", "dimwit", "xyz", "midiots", "antidimwitted"]
    w, l, v = marks.within(words)
    got = {(words[i], marks.words[j]): x for i, j, x in zip(w, l, v)}
    for a in words:
        for b in marks.words:
            n = len(b)
            want = max([kernel(a, b)] + [kernel(a[i:i + n], b) for i in range(len(a) - n + 1) if len(a) > n])
            if want >= X.FLOOR:
                assert got[a, b] == pytest.approx(min(want, 1.0), abs=1e-9)
            else:
                assert (a, b) not in got


def test_gapped_insults_outside_the_training_fold_are_found(spark):
    docs, labels = corpus()
    odd = [(1001, "bakori d.i.m.w.i.t sal n-u-m-s-k-u-l-l po."), (1002, "bakori youareadimwitman sal hesanumskullreally."),
           (1003, "bakori " * 20 + "b_l_o_c_k_h_e_a_d d.i.m.w.i.t."), (1004, "b.a.k.o.r.i t-u-m-e-n salponebakoritumen.")]
    d = spark.createDataFrame(docs + odd, "doc_id long, text string")
    by = {r["doc_id"]: r["predicted"] for r in X.report(d, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    assert (by[1001], by[1002], by[1003], by[1004]) == (1, 1, 1, 0)


def test_runs_of_single_letters_are_read_to_their_end():
    marks = X.Landmarks(["dimwit"])
    for before in (0, 28, 60, 63, 64, 70, 93, 200, 1000):
        for text in (" ".join("ba" * before + "dimwit"), " ".join("ba" * before) + ". " + " ".join("dimwit") + " x y"):
            row, x, _ = X.sentence_vectors(pa.array([text, "po"]), marks)
            assert row.tolist() and set(row) == {0} and x.max() == pytest.approx(1.0)


def test_landmarks_are_insults_not_their_neighbours(spark):
    """Words of a toxic text that many copies hold, and words frequent by chance, are no landmarks."""
    docs, labels = corpus()
    copy = "zuraba " + "kolimo pentari vosgeha " * 4 + "dimwit numskull."
    docs = docs + [(2000 + i, copy.replace("pentari", f"pen{i}tari")) for i in range(60)]
    labels = labels + [(2000 + i, 0, 1) for i in range(60)]
    sample = X.training_sample(spark.createDataFrame(docs, "doc_id long, text string"),
                               spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    marks = X.choose_landmarks(sample)
    assert set(INSULTS) & set(marks.words) and len(set(marks.words) - set(INSULTS)) <= 1


def test_sample_takes_one_row_of_an_id(spark):
    docs = spark.createDataFrame([(1, f"text {i}") for i in range(500)] + [(2, None), (3, "c")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0, 1), (2, 0, 0), (3, 0, 0)], "doc_id long, quality int, toxic int")
    assert X.training_sample(docs, labels, folds=10 ** 6).count() == 3


def test_letter_gaps_score_by_the_kernel():
    marks = X.Landmarks(["idiot", "stupid"])
    row, x, _ = X.sentence_vectors(pa.array(["you idi0t", "an idxiot", "the idxixot", "stuxpid"]), marks)
    assert row.tolist() == [0, 1, 2, 3] and x.max(axis=1).min() >= X.FLOOR
