import html
import re

from pyspark.sql import functions as F

from ticklake.llm.html_text import extract, main_text, op3_html_text
from ticklake.llm.line_templates import drop_recurring_lines, recurring_lines, without_recurring_lines
from ticklake.llm.revisits import canonical_url, resolve_revisits

SF = "/root/testdata/sf0.001"


def test_every_page_of_the_table(spark):
    """The given pages have their text in one article of plain blocks."""
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in op3_html_text(spark, SF).collect():
        body = re.search(r"<article>(.*?)(?:</article>|\Z)", pages[r["page_id"]], re.S).group(1)
        blocks = [" ".join(html.unescape(re.sub(r"<br>", " ", re.sub(r"</?b>|<!--.*?-->", "", b))).split()) for b in re.split(r"</?(?:p|h1)>", body)]
        assert r["text"] == "\n\n".join(b for b in blocks if b) and r["n_chars"] == len(r["text"])


def test_parts_that_are_not_the_article(spark):
    page = """<!doctype html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar"><header>Site &amp; name</header>
    <div id="cookie-notice"><p>We use cookies</p></div><nav><ul><li><a href="/">Home</a></ul></nav><main><h1>Head&shy;line &#233;t&eacute;</h1>
    <p>First <b>bold</b>&nbsp; text<script>if (a < b) "</p>";</script> goes   on.</p><aside>More to read</aside><div class="ad-box">Buy<div>now</div></div>
    <p>Second &lt;b&gt; a < b.<form><input name=q><label>Name</label></form><ul><li>one<li>two</ul><table><tr><td>x<td>y</table></main>
    <section class="comments"><article class="comment"><p>Nice post</p></article></section><footer>(c) us</footer><p>outside"""
    want = ["Head\xadline été", "First bold text goes on.", "Second <b> a < b.", "one", "two", "x y"]
    assert main_text(page) == "\n\n".join(want)
    plain = "<p>" + "long line of text " * 10 + "</p><p>end.</p><div class=sidebar>" + "links " * 50 + "</div>"
    assert main_text(plain) == ("long line of text " * 10).strip() + "\n\nend."
    big = "<article>" + "<p>abc d</p>" * 50_000 + "</article>"
    rows = [(1, None), (2, ""), (3, "no markup at all"), (3, "no markup at all"), (4, "<div"), (5, big), (6, "<!-- open"), (7, "<p>a<p class='x")]
    got = {r["page_id"]: r["text"] for r in extract(spark.createDataFrame(rows, "page_id int, html string")).collect()}
    assert got == {1: "", 2: "", 3: "no markup at all", 4: "", 5: "\n\n".join(["abc d"] * 50_000), 6: "", 7: "a"}


def test_pages_made_to_mislead(spark):
    long = "A paragraph of the story that goes on for quite some words, as they do."
    body = f"<p>{long}</p><p>Second: {long}</p>"
    want = f"{long}\n\nSecond: {long}"
    assert main_text(f"<html><body><article><p>x</p></article><div>{body}</div></body></html>").endswith(want)
    assert main_text(f"<body><form action=/><nav><a href=/>Home</a></nav><article>{body}</article></form></body>") == want
    assert main_text(f"<body><article><form>{body}</form></article></body>") == want
    assert main_text(f"<body><article>{body}<form><input><label>Mail</label></form></article></body>") == want
    assert main_text(f"<article><svg><g><svg><text>a</text></svg><text>b</text></g></svg>{body}</article>") == want
    assert main_text(f"<html><head><title>Open<body><article>{body}</article>") == want
    assert extract(spark.createDataFrame([], "page_id int, html string, text string")).collect() == []


def test_surge_and_dive_by_a_plain_model():
    """Pages without an article: the stretches between surge and dive of the sums, worked out line by line."""
    import random

    rng = random.Random(4)
    for _ in range(200):
        sizes = [rng.choice([0, 0, 0, 0, 3, 40, 90]) for _ in range(rng.randint(1, 25))]
        lines = [f"{i:02d}" + "x" * (n - 2) if n else "" for i, n in enumerate(sizes)]
        page = "".join(f"<p>{x}</p>" if x else "<nav><a href=/>m</a></nav>" for x in lines)
        rows = []  # as the extractor sees them: three empty lines for each part
        for x in lines:
            rows += [x] if x else [""] * 3
        sums = [sum(len(x) for x in rows[i:i + 3]) for i in range(len(rows))]
        stretches, now = [], []
        for i, s in enumerate(sums):
            if s:
                now.append(i)
            if now and (not s or i == len(sums) - 1):
                stretches.append(now)
                now = []
        peak = max(sums, default=0)
        want = [rows[i] for st in stretches if max(sums[i] for i in st) >= 0.2 * peak for i in st if rows[i]]
        assert main_text(page) == "\n\n".join(want)


def test_recurring_templates_go_and_the_rest_stays(spark):
    rows = [(i, f"own words number{i} here\nUpdated by user{i} at 12:{i}\nShare this page with {'abcdefghijklmnopqrstuvwxyz'[i % 26] * 3}\nlast {i * 'x'}", "k") for i in range(12)]
    rows += [(100, None, None), (101, "", "k"), (102, "one\n\none", "k"), (None, "Updated by user9 at 3:4", "k"), (11, "Updated by  user1 at 9", "k"),
             (103, "word " * 100_000, "k")]
    docs = spark.createDataFrame(rows, "doc_id int, text string, line string")
    names = {r["template"]: r["n_docs"] for r in recurring_lines(docs).collect()}
    assert names["Updated by <*> at <*>"] == 13 and names["Share this page with <*>"] == 12
    got = {(r["doc_id"], r["line"], r["text"]) for r in drop_recurring_lines(docs).select("row.*").collect()}
    assert (0, "k", "last ") in got and {r[2] for r in got if r[0] == 102} == {"one\n\none"} and (100, None, None) in got
    assert all("Updated" not in (t or "") and "Share" not in (t or "") for _, _, t in got)
    kept = without_recurring_lines(docs)
    assert kept.columns == docs.columns and not [r for r in kept.collect() if r["doc_id"] is None] and kept.filter("doc_id = 101").count() == 1
    assert without_recurring_lines(docs.limit(0)).collect() == []


def test_recurring_lines_at_any_size(spark):
    """One line of 60 words, half of its copies with three words edited: the unchanged copies lose it at any size."""
    import random

    line = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60))
    for n in (20, 100, 2000):
        draw, rows = random.Random(n), []
        for i in range(n):
            w = line.split()
            for k in draw.sample(range(60), 3) if i % 2 else ():
                w[k] = "edit" + "".join(draw.choices("abcdefgh", k=6))
            rows.append((i, f"own text of {'abcdefghij'[i % 10] * (i + 1)}\n" + " ".join(w)))
        got = {r["row"]["doc_id"]: r["n_dropped"] for r in drop_recurring_lines(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
        assert all(got[i] for i in range(0, n, 2)), n
    # a short line whose leading tokens alone recur is no boilerplate
    rows = [(i, f"in the end {'abcdefghijklmnopqrstuvwxyz'[i] * 3} {'zyxwvutsrqponmlkjihgfedcba'[i] * 4} came") for i in range(26)]
    got = drop_recurring_lines(spark.createDataFrame(rows, "doc_id int, text string")).agg(F.sum("n_dropped")).first()[0]
    assert got == 0
    # an extra column named as those within
    docs = spark.createDataFrame([(i, "a line that recurs", 1, "x") for i in range(12)], "doc_id int, text string, n int, kept string")
    assert {(r["row"]["n"], r["row"]["kept"], r["row"]["text"]) for r in drop_recurring_lines(docs).collect()} == {(1, "x", "")}


def test_revisits(spark):
    h = lambda **k: [(n.replace("_", "-"), v) for n, v in k.items()]
    rows = [
        (1, "HTTP://www.Ex.com:80/a/?utm_x=1&b=2&a=1#f", 10, False, "d1", h(ETag='W/"v1"', Date="1", Server="s")), (2, "https://ex.com/a?a=1&b=2", 20, False, "d2", h(ETag='"v2"', Date="2", Server="t")),
        (3, "ex.com/a?a=1&b=2", 15, True, None, h(etag='"v1"', date="3", server="no")), (4, "ex.com/a?a=1&b=2", 90_000_000, True, None, h(etag='"v2"')),
        (5, "ex.com/a?a=1&b=2", 20, True, None, h(etag='"v2"')), (6, "ex.com/b", 20, True, "d", None), (7, None, 20, True, "d", None),
        (8, "ex.com/a?a=1&b=2", 30, True, "d2", None), (9, "ex.com/a?a=1&b=2", 30, True, None, None), (10, "ex.com/a?a=1&b=2", None, True, None, None),
        (9, "ex.com/a?a=1&b=2", 30, True, None, None),
    ]
    df = spark.createDataFrame(rows, "record_id int, url string, s int, is_revisit boolean, digest string, headers array<struct<name:string,value:string>>")
    df = df.selectExpr("*", "timestamp_seconds(s) as time", "'x' as response")
    for chunk in (86_400, 7):
        got = {}
        for r in resolve_revisits(df, chunk).collect():
            got[r["record_id"]] = (r["status"], r["validator"], r["refers_to"], {x["name"]: x["value"] for x in r["headers"]})
        assert got[3] == ("resolved", "etag", 1, {"etag": '"v1"', "date": "3", "server": "s"})
        assert got[4][:3] == ("resolved", "etag", 2) and got[4][3]["server"] == "t"
        assert got[5][:3] == ("not_matched", "etag", None) and got[6][0] == "no_response" and got[7][0] == "no_url"
        assert got[8][:3] == ("resolved", "digest", 2) and got[9][:2] == ("no_validator", None) and got[10][0] == "no_response"
        assert resolve_revisits(df, chunk).count() == 9
    assert resolve_revisits(df.limit(0)).collect() == []
    urls = spark.createDataFrame([("",), (" http://A.b/ ",), ("a.b?utm_s=1",)], "u string")
    assert [r[0] for r in urls.select(canonical_url(F.col("u"))).collect()] == [None, "a.b", "a.b"]
