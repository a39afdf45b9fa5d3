import hashlib
import random
import re
from fractions import Fraction

from recfold.llm import mixing as M


def fill(budget, children):
    """{name: (weight, cap)} -> shares, by filling round after round."""
    out = {n: 0 for n in children}
    live = {n for n, (w, c) in children.items() if w > 0 and c > 0}
    budget = min(budget, sum(c for n, (w, c) in children.items() if w > 0))
    while True:
        total = sum(children[n][0] for n in live)
        full = {n for n in live if Fraction(budget * children[n][0], total) >= children[n][1]}
        if not full:
            break
        for n in full:
            out[n] = children[n][1]
            budget -= children[n][1]
        live -= full
        if not live:
            return out
    total = sum(children[n][0] for n in live)
    for n in live:
        out[n] = budget * children[n][0] // total if total else 0
    left = budget - sum(out[n] for n in live)
    for n in sorted(live)[:left]:
        out[n] += 1
    return out


def brute(docs, budget, weights, epochs, seed):
    count = lambda t: len(re.findall("[^\x20\x09-\x0d]+", t or ""))
    def domain(s):
        m = re.search(r"([0-9]{1,9})$", s or "")
        return f"domain{int(m[1]) % 3}" if m else "other"
    rows = [(d, t, l, s, (domain(s), l or "", s or ""), count(t)) for d, t, l, s in docs]
    leaf = {}
    for r in rows:
        leaf[r[4]] = leaf.get(r[4], 0) + r[5]
    w = lambda i, n: weights.get(M.LEVELS[i], {}).get(n, 1)
    cap = {p: t * epochs if all(w(i, n) > 0 for i, n in enumerate(p)) else 0 for p, t in leaf.items()}
    given = {(): min(budget, sum(cap.values()))}
    for i in range(3):
        new = {}
        for parent, b in given.items():
            kids = {}
            for p, c in cap.items():
                if p[:i] == parent:
                    kids[p[i]] = (w(i, p[i]), kids.get(p[i], (0, 0))[1] + c)
            new |= {(*parent, n): g for n, g in fill(b, kids).items()}
        given = new
    out = []
    for p, t in leaf.items():
        if not t:
            continue
        whole, rest = divmod(given[p], t)
        mine = [r for r in rows if r[4] == p]
        key = lambda r: str(r[0]) if r[0] is not None else "#" + hashlib.md5((r[1] or "").encode()).hexdigest()
        h = {id(r): hashlib.md5(f"{seed}/{whole}/{key(r)}".encode()).hexdigest() for r in mine}
        taken, used = set(), 0
        for x in sorted(set(h.values())):
            used += sum(r[5] for r in mine if h[id(r)] == x)
            if used > rest or not rest:
                break
            taken.add(x)
        for r in mine:
            out += [(r[0], r[2], r[3], p[0], r[5], e) for e in range(whole + (h[id(r)] in taken))]
    return sorted(out, key=str)


def test_equals_brute_force(spark):
    rng = random.Random(1)
    docs = [(i, "w " * rng.randint(0, 60), rng.choice(["en", "en", "en", "de", None]), rng.choice(["src1", "src2", "src5", "web", None, "src0"])) for i in range(250)]
    docs += [(3, "a b c", "en", "src1"), (3, "a b c", "en", "src1"), (None, "n n", "fr", "src9"), (None, "n n", "fr", "src9"), (None, "m", "fr", "src9"),
             (900, None, "en", "src1"), (901, "", "xx", "empty"), (902, "long " * 20_000, "es", "src7")]
    df = spark.createDataFrame([(*d, "c") for d in docs], "doc_id long, text string, lang string, source string, epoch string").repartition(3)
    weights = {"domain": {"domain0": 5, "domain1": 1, "other": 0}, "lang": {"en": 7, "de": 3}, "source": {"src5": 4}}
    for budget, epochs in ((9_000, 3), (31, 1), (10 ** 9, 2)):
        got = M.mix(df, budget, weights, epochs, seed=3).select("doc_id", "lang", "source", "domain", "n_tokens", "epoch")
        assert sorted((tuple(r) for r in got.collect()), key=str) == brute(docs, budget, weights, epochs, 3), budget


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert M.report(df).collect() == []
