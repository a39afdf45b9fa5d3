from recfold.llm import wrappers as X


def page(n, extra="", body=None):
    paras = "".join(f"<p>Para {n} {i} with &lt;text&gt;<br>and&nbsp;more</p>" for i in range(n)) if body is None else body
    return (f"<html><head><title>t{n}</title><script>var a='</p>';</script></head><body><nav><ul>{'<li><a href=/x>m</a>' * 3}</ul></nav>"
            f"<div class='cookie-notice'>We use cookies</div><article><h1>Head {n}</h1>{paras}{extra}</article>"
            f"<aside>side</aside><div class=comments><p>reader {n}</p></div><form>f</form><footer>c {n}")


def plain(n):
    return (f"<body><div id=top>Site name</div><div id=c>{''.join(f'<p>Story {n} line {i} that is rather long</p>' for i in range(3))}</div>"
            f"<div id=links>{'<a href=1>other</a> ' * 9}</div><div>All rights reserved</div></body>")


ROWS = [(1, "http://a.x/1", page(2)), (2, "http://a.x/2", page(4, "<div class=ad>buy</div><ul><li>one<li>two</ul>")), (3, "https://A.x:80/3", page(1)),
        (4, "http://b.x/", plain(1)), (5, "http://b.x/2", plain(2)), (6, "http://b.x/3", plain(3)), (7, None, None), (8, "::bad", ""), (9, "http://[x", "<p>a<p>b  c\n d"),
        (1, "http://a.x/1", page(2)), (None, "http://a.x/9", page(3)), (10, "http://a.x/cut", "<article><p>kept <b>bold</b>ly</p><p>last <a hre"),
        (11, "http://a.x/long", page(1, body="<p>" + "word " * 50_000 + "</p>"))]


def body(n):
    return "\n".join([f"Head {n}"] + [f"Para {n} {i} with <text> and more" for i in range(n)])


def test_main_text(spark):
    df = spark.createDataFrame([(p, u, h, "h") for p, u, h in ROWS], "page_id long, url string, html string, host string").repartition(4)
    got = {(r["page_id"], r["url"]): (r["text"], r["n_chars"]) for r in X.extract(df).collect()}
    assert X.extract(df).count() == len(ROWS)
    assert all(n == len(t) for t, n in got.values())
    text = {k[0]: t for k, (t, _) in got.items()}
    assert text[1] == body(2) and text[3] == body(1) and text[None] == body(3)
    assert text[2] == body(4) + "\none\ntwo"
    assert text[4] == "\n".join(f"Story 1 line {i} that is rather long" for i in range(3))
    assert text[7] == "" and text[8] == "" and text[9] == "a\nb c d" and text[10] == "kept boldly\nlast"
    assert text[11] == "Head 1\n" + ("word " * 50_000).strip()


def test_wrapper_expression(spark):
    df = spark.createDataFrame(ROWS[:3], "page_id long, url string, html string")
    (row,) = X.infer(df).collect()
    assert row["host"] == "a.x"
    assert row["expression"] == ("(html/body/nav/ul/li #TEXT)+ (html/body/div.cookie-notice #TEXT) (html/body/article/h1 #TEXT) "
                                 "(html/body/article/p #TEXT)+ (html/body/article/div.ad #TEXT)? (html/body/article/ul/li #TEXT)* "
                                 "(html/body/aside #TEXT) (html/body/div.comments/p #TEXT) (html/body/form #TEXT) (html/body/footer #TEXT)")


def test_joined_wrappers_equal_broadcast_ones(spark, monkeypatch):
    df = spark.createDataFrame(ROWS, "page_id long, url string, html string")
    want = sorted(map(str, X.extract(df).collect()))
    monkeypatch.setattr(X, "BROADCAST_BYTES", 0)
    assert sorted(map(str, X.extract(df).collect())) == want


def test_empty(spark):
    assert X.extract(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_fold_and_align():
    assert X.fold(list("abababc")) == [(0, 3, 2), (6, 1, 1)]
    assert X.fold(list("aaab")) == [(0, 3, 1), (3, 1, 1)]
    slot = lambda p: [p, False, False, 1, 1, 0, "d"]
    m = X.merge([slot(c) for c in "abcd"], [slot(c) for c in "axcd"])
    assert [(s[0], s[1]) for s in m] == [("a", False), ("b", True), ("x", True), ("c", False), ("d", False)]


def test_copies_of_a_page_do_not_make_its_blocks_constant(spark):
    quote = "<blockquote>A passage that only this page of the host has</blockquote>"
    own = plain(9).replace("</div><div id=links>", quote + "</div><div id=links>")
    rows = [(i, f"http://c.x/{i}", plain(i)) for i in range(4)] + [(10 + i, f"http://c.x/copy{i}", own) for i in range(4)]
    for parts in (1, 4):
        df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(parts)
        text = {r["page_id"]: r["text"] for r in X.extract(df).collect()}
        story = lambda n: "\n".join(f"Story {n} line {i} that is rather long" for i in range(3))
        assert all(text[10 + i] == story(9) + "\nA passage that only this page of the host has" for i in range(4))
        assert all(text[i] == story(i) for i in range(4))


def odd(n):
    """A page whose classes mean nothing: menu, notice, story, teaser and imprint by structure alone."""
    story = "".join(f"<p>Tale {n} part {i}, told at some length here</p>" for i in range(2 + n % 3))
    return (f"<body><div class=qa>{'<a href=1>Somewhere</a> ' * 5}</div><div class=qb><p>Please accept this and that</p></div>"
            f"<div class=qc><h2>Tale {n}</h2>{story}</div><div class=qd>Weather today {n}</div><div class=qe>No rights given</div>")


def odd_text(n):
    return "\n".join([f"Tale {n}"] + [f"Tale {n} part {i}, told at some length here" for i in range(2 + n % 3)])


def texts(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    return {r["page_id"]: r["text"] for r in X.extract(df).collect()}


def test_slots_decide_where_classes_mean_nothing(spark, monkeypatch):
    rows = [(n, f"http://odd.x/{n}", odd(n)) for n in range(9)]
    want = {n: odd_text(n) for n in range(9)}
    assert texts(spark, rows) == want
    monkeypatch.setattr(X, "GROUP", 2)  # merged in many rounds
    assert texts(spark, rows) == want


def test_a_name_without_the_varying_text_is_not_followed(spark):
    card = "<article><p><a href=/x>Read this one</a></p></article>"
    rows = [(n, f"http://card.x/{n}", odd(n).replace("<div class=qd>", card * 2 + "<div class=qd>")) for n in range(6)]
    assert texts(spark, rows) == {n: odd_text(n) for n in range(6)}


def test_frame_slots_inside_main_are_dropped(spark):
    rows = [(n, f"http://m.x/{n}", f"<main><h2>Summary</h2><p>Told {n} once</p><p>Told {n} twice</p><div class=qg>Tell a friend about us</div>"
                                   f"<div class=qh><a href=1>More {n}</a></div></main>") for n in range(5)]
    assert texts(spark, rows) == {n: f"Summary\nTold {n} once\nTold {n} twice" for n in range(5)}


def test_alignment_is_a_longest_one_at_every_size(monkeypatch):
    import random

    rng = random.Random(5)

    def longest(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            row, old = [0], row
            for j, y in enumerate(b):
                row.append(old[j] + 1 if x == y else max(old[j + 1], row[j]))
        return row[-1]

    cases = [("", ""), ("a", ""), ("", "ab"), ("abc", "abc"), ("ab" * 40, "ba" * 30)]
    cases += [tuple("".join(rng.choice("abcd") for _ in range(rng.randrange(60))) for _ in "xy") for _ in range(60)]
    for cells in (X.CELLS, 10):
        monkeypatch.setattr(X, "CELLS", cells)
        for a, b in cases:
            found = X.align(list(a), list(b))
            assert [i for i, _ in found if i is not None] == list(range(len(a)))
            assert [j for _, j in found if j is not None] == list(range(len(b)))
            both = [(i, j) for i, j in found if i is not None and j is not None]
            assert all(a[i] == b[j] for i, j in both) and len(both) == longest(a, b)
