"""Whitening, vector codes and page texts against plain computations."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from wattline.llm import html_text, vector_codes, whitening
from wattline.llm.queries import QUERIES
from wattline.llm.tables import load

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int, n long, code string, `a.b` string"
NAN, INF = float("nan"), float("inf")


def rows_of(vectors: list, labels=None) -> list[tuple]:
    return [(i, v, labels[k] if labels else k % 3, 1, "c", "x") for k, (i, v) in enumerate(vectors)]


def bad_vectors(width: int) -> list[tuple]:
    return [
        (9001, None), (9002, []), (9003, [NAN] * width), (9004, [None] + [1.0] * (width - 1)),
        (9005, [INF] + [0.0] * (width - 1)), (9006, [1e30] * width), (9007, [1.0] * (width + 1)),
    ]


def spectrum(kind: str, size: int = 24) -> np.ndarray:
    return {
        "spread": np.linspace(1, 50, size),
        "clusters": np.concatenate([100 + np.arange(8) * 1e-7, 7 + np.arange(8) * 1e-5, np.linspace(1, 2, size - 16)]),
        "equal": np.full(size, 3.0),
        "few": np.concatenate([np.zeros(size - 3), [1.0, 2.0, 3.0]]),
        "steep": np.logspace(0, 10, size),
    }[kind]


@pytest.mark.parametrize("kind", ["spread", "clusters", "equal", "few", "steep"])
def test_eigenpairs_are_exact_to_double_precision(kind):
    values = np.sort(spectrum(kind))[::-1]
    turn = np.linalg.qr(np.random.default_rng(1).standard_normal((len(values), len(values))))[0]
    matrix = (turn * values) @ turn.T
    matrix = (matrix + matrix.T) / 2
    found, vectors = whitening.eigenpairs(matrix)
    wide = vectors.astype(np.longdouble)
    largest = np.abs(values).max()
    assert np.abs(found - values).max() <= 1e-14 * largest
    assert np.abs(matrix.astype(np.longdouble) @ wide - wide * found).max() <= 1e-15 * largest
    assert np.abs(wide.T @ wide - np.eye(len(values))).max() <= 1e-14
    single = np.linalg.eigh(matrix.astype(np.float32))[1].astype(float)
    if kind in ("spread", "clusters"):
        # The starting vectors are far worse, so it is the refinement that brings this about.
        assert np.abs(matrix @ single - single * found[::-1]).max() > 1e-9 * largest


def test_whitening_matches_a_plain_computation(spark):
    rng = np.random.default_rng(2)
    good = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(rng.standard_normal((300, 20)) * 3 + 40)]
    good += [(3, good[3][1]), (None, good[3][1]), (500, good[4][1])]  # repeated, without id, copy
    table = spark.createDataFrame(rows_of(good + bad_vectors(20)), SCHEMA)
    found = whitening.whiten(table.repartition(7)).collect()
    x = np.floor(64 * np.array([v for _, v in good], np.float32).astype(float)) + 1_000_000
    listed = np.unique(x, axis=0)
    n, sums = len(listed), listed.sum(0)
    spread = np.cov(listed.T, bias=True)
    values, vectors = np.linalg.eigh(spread)
    values, vectors = values[::-1][:16], vectors[:, ::-1][:, :16]
    assert len(found) == 16 * len(good) and {r["n"] for r in found} == {n} == {300}
    errors = {r["identity_error"] for r in found}
    assert len(errors) == 1 and errors.pop() < 1e-12
    rows = {(r["id"], r["component"]): r for r in found}
    sign = np.ones(16)
    for at, (i, _) in enumerate(good):
        want = (x[at] - sums / n) @ vectors / np.sqrt(values)
        got = np.array([rows[i, c]["whitened"] for c in range(1, 17)])
        if at == 0:
            sign = np.sign(want * got)
        assert np.allclose(got, want * sign, rtol=0, atol=1e-9)
        deviation = sum((n * int(a) - int(s)) ** 2 for a, s in zip(x[at], sums))
        assert rows[i, 1]["deviation"] == deviation
        assert all(math.isclose(rows[i, c]["explained"], values[c - 1] / np.trace(spread), rel_tol=1e-12) for c in range(1, 17))


def test_whitening_of_little_or_nothing(spark):
    few = spark.createDataFrame(rows_of([(i, [float(i), 1.0, float(i % 2)]) for i in range(4)]), SCHEMA)
    found = whitening.whiten(few).collect()
    assert len(found) == 12 and all((r["whitened"] is None) == (r["component"] == 3) for r in found)
    assert max(r["identity_error"] for r in found) < 1e-12
    same = whitening.whiten(spark.createDataFrame(rows_of([(1, [1.0, 2.0]), (2, [1.0, 2.0])]), SCHEMA)).collect()
    assert len(same) == 4 and all(r["n"] == 1 and r["deviation"] == 0 for r in same)
    assert all(r["whitened"] is None and r["explained"] is None and r["identity_error"] is None for r in same)
    huge = spark.createDataFrame(rows_of([(i, [1e7 * i, 0.5]) for i in range(2)]), SCHEMA)
    assert {r["deviation"] for r in whitening.whiten(huge).collect()} == {int(64e7) ** 2 * 1}
    assert whitening.whiten(few.limit(0)).count() == 0
    assert whitening.whiten(spark.createDataFrame(rows_of(bad_vectors(3)[:6]), SCHEMA).where("vec_id < 9003")).count() == 0


def lloyd(vectors: list, labels: list, parts: int = 8, entries: int = 16, rounds: int = 6) -> tuple[list, str]:
    """Codes and errors by plain loops over Python's whole numbers; ``vectors`` as (id, components)."""
    whole = [[math.floor(4096 * float(np.float32(c))) for c in v] for _, v in vectors]
    size = len(whole[0]) // parts
    order = sorted(range(len(vectors)), key=lambda k: (vectors[k][0] is None, vectors[k][0] or 0, whole[k]))
    books = [[whole[k][p * size : (p + 1) * size] for k in order[:entries]] for p in range(parts)]

    def choose(x, p):
        far = [sum((a - b) ** 2 for a, b in zip(x[p * size : (p + 1) * size], e)) for e in books[p]]
        return min(range(len(far)), key=lambda j: (far[j], j)), min(far)

    for _ in range(rounds):
        picks = [[choose(x, p)[0] for p in range(parts)] for x in whole]
        for p in range(parts):
            for e in range(len(books[p])):
                own = [x[p * size : (p + 1) * size] for x, k in zip(whole, picks) if k[p] == e]
                if own:
                    books[p][e] = [sum(c) // len(own) for c in zip(*own)]
    last = [[choose(x, p) for p in range(parts)] for x in whole]
    errors = [sum(d for _, d in row) for row in last]
    sums: dict = {}
    for label, e in zip(labels, errors):
        sums[label] = sums.get(label, 0) + e
    text = ",".join(str(c) for book in books for e in book for c in e)
    rows = [("".join(f"{e:02x}" for e, _ in row), err, sums[l]) for row, err, l in zip(last, errors, labels)]
    return rows, hashlib.sha256(text.encode()).hexdigest()


def test_codes_match_plain_lloyd(spark, monkeypatch):
    monkeypatch.setattr(vector_codes, "RESIDENTS", 16)  # many owners
    rng = np.random.default_rng(3)
    good = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(rng.standard_normal((160, 16)))]
    good += [(3, good[3][1]), (None, good[3][1]), (0, good[9][1])]
    good += [(600 + i, good[7][1]) for i in range(80)]  # a third are copies
    labels = [None if k % 5 == 0 else k % 4 for k in range(len(good))]
    bad = [(i, v) for i, v in bad_vectors(16)]
    rows = rows_of(good, labels) + rows_of(bad)
    found = vector_codes.encode(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    want, digest = lloyd(good, labels)
    keyed = sorted((i is None, i or 0, *w) for (i, _), w in zip(good, want))
    assert sorted((r["id"] is None, r["id"] or 0, r["code"], r["error"], r["label_error"]) for r in found) == keyed
    assert {r["codebooks_sha256"] for r in found} == {digest}


def test_only_members_that_change_entry_are_shuffled(spark):
    books = np.array([[[0, 0], [10, 10]]])
    members = spark.createDataFrame([(0, 0, s, [x, x]) for s, x in enumerate([0, 1, 9, 2])], vector_codes.MEMBERS_SQL)
    seen = members.mapInArrow(vector_codes._review(books), vector_codes.SEEN_SQL)
    assert [r["part"] for r in seen.where("moved").collect()] == [[9, 9]]
    assert "Exchange" not in seen._jdf.queryExecution().executedPlan().toString()
    assert vector_codes.updated(members, books).tolist() == [[[3, 3], [10, 10]]]


def test_codes_of_little_or_nothing(spark):
    few = [(5, [0.5, -0.5, 1.0, 0.0, 0.0, 0.0, 0.25, 0.1]), (2, [0.5, 0.5, 1.0, 0.0, -1e-4, 0.0, 0.25, 0.1])]
    table = spark.createDataFrame(rows_of(few, [None, None]), SCHEMA)
    want, digest = lloyd(few, [None, None])
    found = {r["id"]: r for r in vector_codes.encode(table).collect()}
    assert [(found[i]["code"], found[i]["error"], found[i]["label_error"]) for i, _ in few] == want
    assert found[5]["codebooks_sha256"] == digest
    assert vector_codes.encode(table.limit(0)).count() == 0
    with pytest.raises(ValueError, match="equal parts"):
        vector_codes.encode(spark.createDataFrame(rows_of([(1, [1.0] * 9)]), SCHEMA))


def test_distances_are_exact_beyond_double_precision():
    parts, book = np.array([[1 << 27, 1]]), np.array([[-(1 << 27), 0], [-(1 << 27), 1]])
    best, far = vector_codes.nearest(parts, book)
    assert best.tolist() == [1] and far.tolist() == [1 << 56]


def test_vector_queries_match_plain_computations(spark):
    rows = load(spark, SF_DIR, "embeddings").collect()
    want, digest = lloyd([(r["vec_id"], r["embedding"]) for r in rows], [r["label"] for r in rows])
    found = QUERIES["op12_resident_lloyd"](spark, SF_DIR).collect()
    assert sorted((r["vec_id"], r["code"], r["error"], r["label_error"]) for r in found) == sorted(
        (r["vec_id"], *w) for r, w in zip(rows, want)
    )
    assert {r["codebooks_sha256"] for r in found} == {digest}
    white = QUERIES["op11_refined_whitening"](spark, SF_DIR)
    assert white.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert white.count() == 16 * len(rows)


LONG = "A sentence of the article, which goes on, as such sentences do, for a while; then it ends."

PAGES = {
    "malformed": (
        f"<title>no</title><script>var t='</p>';if(a<b){{}}</script><nav><ul><li><a href=x>Menu</a></ul></nav><div class=ad>Buy, buy, buy.</div>"
        f"<article><h1>Ti&amp;tle</h1><p><b>{LONG}<br><p>Sh.<p>Ends &lt;here&gt;\n\n now.</article><footer>&copy; us</footer>",
        ["Ti&tle", LONG, "Sh.", "Ends <here> now."],
    ),
    "no article element": (
        f"<body class=has-sidebar><form id=aspnetForm><div id=header>Site, and its motto.</div><div class=left><h1>Title</h1>"
        f"<div class=body><p>{LONG}</p><p>Short.</p><ul><li>one<li>two</ul><p>{LONG}</p></div><div class=comments><p>{LONG * 3}</p></div></div>"
        f"<div class=sidebar><p>{LONG}</p></div><div class=cookie-notice><p>{LONG}</p></div></form>",
        ["Title", LONG, "Short.", "one", "two", LONG],
    ),
    "comments as articles": (
        f"<main><article><header><h1>Head <em>line</em></h1><p>By X</p></header><p>{LONG}</p><aside>{LONG}</aside><div>Direct, and short.</div>"
        f"Bare text.</article><section id=comments><article class=comment><p>{LONG * 4}</p></article></section></main><!-- open <p>no</p>",
        ["Head line", LONG, "Direct, and short.", "Bare text."],
    ),
    "div paragraphs": (
        f"<body><div class=nav><a href=a>a</a></div><div class=text>{'<div>' + LONG + '</div><div>Tiny.</div>'}<div>{LONG}</div></div>"
        "<div class=links><a href=1>one thing</a> <a href=2>other thing</a></div>",
        [LONG, "Tiny.", LONG],
    ),
    "hidden": (f"<p>{LONG}</p><div style='display: none'><p>{LONG}</p></div><p hidden>{LONG}</p><noscript>{LONG}</noscript>", [LONG]),
    "table": (f"<article><p>{LONG}</p><table><tr><td>a</div>b<td>c</table></article>", [LONG, "a", "b", "c"]),
    "only beside": ("<nav>menu</nav><div class=ad>Buy.</div><footer>us</footer>", []),
    "link heading": (f"<article><h2><a href=x>Linked title</a></h2><p>{LONG}</p><ul><li><a href=1>x</a><li><a href=2>y</a></ul></article>", ["Linked title", LONG]),
    "references": ("<p title='a>b'>&#39;&eacute;&nbsp;&#x41;&amp;amp; &copy;</p>", ["'é A&amp; ©"]),
}


@pytest.mark.parametrize("name", sorted(PAGES))
def test_article_of_a_page(name):
    page, want = PAGES[name]
    assert html_text.article_text(page).split("\n\n") == (want or [""])


def test_content_paths_have_high_ratios():
    page = html_text.Page(f"<div>{'<p>' + LONG + '</p>'}<p>{LONG}</p></div><span>ok</span><div class=x>So so</div>")
    level = html_text._levels(
        np.array(page.paths)[page.elements], np.array(page.plain), np.array(page.linked), np.array([4, 4, 0, 0])
    )
    assert level[0] == level[1] > 5 * level[2:].max()


def test_long_and_odd_pages_are_read_whole():
    many = "<p>" + "word, " * 20 + "\n"
    assert html_text.article_text(many * 5_000).count("\n\n") == 4_999
    for odd in ("<b>" * 3_000, "<div>" * 3_000, "<table><td>" * 3_000, "<i>" * 2_000 + "<p>" + "</i>" * 3_000, '<a x="' * 9_000 + ">"):
        assert html_text.article_text(f"{odd}some text").endswith("some text") or odd.startswith("<a")
    assert html_text.article_text(None) == html_text.article_text("") == html_text.article_text("<script>") == ""


def test_pages_table(spark):
    long_page = f"<article>{('<p>' + LONG) * 2_000}</article>"
    rows = [(1, "u", PAGES["table"][0]), (1, "u", PAGES["table"][0]), (None, None, "<p>x, y.</p>"), (2, "u", None), (3, "u", ""), (4, "u", long_page)]
    table = spark.createDataFrame([(*r, "t", 5, 1) for r in rows], "page_id long, url string, html string, text string, n_chars long, id int")
    found = html_text.extract(table).collect()
    assert sorted((r["id"] or 0, r["url"] or "", r["n_chars"]) for r in found) == sorted(
        (i or 0, u or "", len(html_text.article_text(h))) for i, u, h in rows
    )
    assert all(r["n_chars"] == len(r["text"]) for r in found)
    assert html_text.extract(table.limit(0)).count() == 0


def test_page_query_finds_the_given_articles(spark):
    """Every page of the given table has its article in one element, written with p, h1, b and br."""
    import html
    import re

    for row, found in zip(
        load(spark, SF_DIR, "pages").orderBy("page_id").collect(),
        QUERIES["op13_tag_path_ratios"](spark, SF_DIR).orderBy("page_id").collect(),
    ):
        inside = re.search(r"<article>(.*)</article>", row["html"], re.S).group(1)
        blocks = (" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split("</?(?:p|h1)>", inside))
        assert found["text"] == "\n\n".join(b for b in blocks if b) and found["url"] == row["url"]
