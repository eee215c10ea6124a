"""Pages, archives, conversations, the registered queries and the pipeline."""

from __future__ import annotations

import hashlib
from collections import defaultdict
from pathlib import Path

import oracle
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from scoreloom.llm import chat, html, queries, warc

FOLDER = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


def texts(page: str) -> str:
    return html.Page(page).text()


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("", ""),
        ("<p>a &amp; b&nbsp;c<br>d <b>e</p><p>f</b>", "a & b c d e\nf"),
        ("<nav>x</nav><article><h1>T</h1><p>a<p>b</article><footer>y</footer>", "T\na\nb"),
        ("<div class='ad box'>x</div><main>a<aside>n</aside></main>", "a"),
        ("<header><p>m</header><article><header><h1>T</h1></header>a</article>", "T\na"),
        ("<article>a<div class=comments>c</div><form>f</form></article>", "a"),
        ("<script>var t='</p><p>x';</script><style>p{}</style><p>a", "a"),
        ("<p>a &am</p><p>1 < 2 &lt;b&gt;</p><a href='x", "a &am\n1 < 2 <b>"),
        ("<ul><li>a<li>b</ul><table><tr><td>c<td>d</table>", "a\nb\nc\nd"),
        ("<!-- <p>x</p> --><p title='a>b'>y</p>", "y"),
    ],
)
def test_page_text(page, text):
    assert texts(page) == text


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<article><p title='the hidden cost'>a</p><p title=\"x hidden\">b</p></article>", "a\nb"),
        ("<p data-id='social-12'>a</p><p data-role=menu>b</p><p x-class=ad>c</p>", "a\nb\nc"),
        ("<p title=' class=ad'>a</p><p alt='aria-hidden=true'>b</p><p data-hidden>c</p>", "a\nb\nc"),
        ("<p hidden>a</p><p HIDDEN=''>b</p><p id=x hidden/>c</p><p aria-hidden = 'True'>d</p>e", "e"),
        ("<p title='a'hidden>a</p><p ID=social-12>b</p><p role='menu'>c</p><p class = \"ad\">d</p>e", "e"),
        ("<p aria-hidden=false class='x y' id=z>a</p><p class=a class=ad>b</p>", "a\nb"),
    ],
)
def test_only_whole_attributes_count(page, text):
    assert texts(page) == text


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_templates_of_a_host_are_deleted(spark, limit):
    rows = []
    for i in range(30):
        body = "<div><p>Shared line.</p></div>" if i % 2 else ""
        own = f"<div><span>Page {i} says {i * 7}</span></div>"
        rows.append((i, f"http://a.example/{i}", f"<body><div>Join us <i>now</i></div>{body}{own}", 1))
        rows.append((100 + i, f"http://b{i}.example/", f"<body><div>Join us <i>now</i></div>{own}", 1))
    same = "<article><p>Always the same.</p></article>"
    rows += [(200 + i, f"http://c.example/{i}", same, 1) for i in range(10)]
    rows += [(300, None, None, 1), (301, "not a url", "<p>x", 1), (301, "not a url", "<p>x", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = html.extract(pages, broadcast_subtrees=limit)
    assert got.columns == ["page_id", "url", "text"]
    found = {r["page_id"]: r["text"] for r in got.collect()}
    assert got.count() == len(rows)
    for i in range(30):
        assert found[i] == f"Page {i} says {i * 7}"
        assert found[100 + i] == f"Join us now\nPage {i} says {i * 7}"
    assert {found[200 + i] for i in range(10)} == {"Always the same."}
    assert (found[300], found[301]) == ("", "x")
    assert html.extract(pages.limit(0)).isEmpty()


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_copies_of_a_page_are_no_template(spark, limit):
    rows = []
    for i in range(12):
        head = f"<head><link href='http://a.example/{i}'></head>"
        links = f"<a href='/share?of={i}'>Open</a>"
        text = "<div><p>One story.</p><p>Told often.</p></div>"
        rows.append((i, f"http://a.example/{i}", f"<html>{head}<body>{text}{links}</body></html>"))
        rows.append((100, "http://b.example/", f"<body>{text}</body>"))
        own = f"<div><p>Page {i}</p></div>"
        rows.append((200 + i, f"http://c.example/{i}", f"<body><div>Join <i>now</i></div>{own}"))
    rows += [(300, "http://c.example/3", rows[11][2])] * 3
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = html.extract(pages, broadcast_subtrees=limit).collect()
    story = "One story.\nTold often."
    want = [(i, f"{story}\nOpen") for i in range(12)] + [(100, story)] * 12
    want += [(200 + i, f"Page {i}") for i in range(12)] + [(300, "Page 3")] * 3
    assert sorted((r["page_id"], r["text"]) for r in got) == sorted(want)


def test_a_template_stays_one_as_its_host_grows(spark):
    menu = "<div><span>News</span> <span>Sport</span></div>"
    rows = [
        (i, "http://a.example/", f"<body>{menu if i < 6 else ''}<div><p>Page {i}</p></div>")
        for i in range(300)
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for n in (12, 300):
        got = html.extract(pages.filter(F.col("page_id") < n)).collect()
        assert {r["page_id"]: r["text"] for r in got} == {i: f"Page {i}" for i in range(n)}


def test_audit_finds_exactly_what_differs(spark):
    n = 700
    rows = [(i, f"http://x/{i}", "h" * (i % 50)) for i in range(n)] + [(None, None, None)] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    data = warc.record(F.col("page_id"), F.col("url"), F.col("html"))
    records = pages.select(
        "page_id", F.octet_length(data).cast("long").alias("size"), warc.digest(data).alias("hash")
    )
    placed = warc.manifest(records, ["page_id", "hash"], file_records=64).cache()
    at = 0
    for r in sorted(placed.collect(), key=lambda r: r["ordinal"]):
        at = 0 if r["ordinal"] % 64 == 0 else at
        assert (r["file"], r["offset"]) == (r["ordinal"] // 64, at)
        at += r["size"]
    bad = {0, 17, 18, 300, n + 1}
    rotten = F.col("ordinal").isin(*bad)
    hash_ = F.when(rotten, F.when(F.col("ordinal") > 17, F.lit("x"))).otherwise(F.col("hash"))
    one = warc.tree(placed, fan_out=4)
    assert warc.audit(one, warc.tree(placed, fan_out=4), fan_out=4).isEmpty()
    other = warc.tree(placed.withColumn("hash", hash_), fan_out=4)
    found = warc.audit(one, other, fan_out=4)
    assert {r["node"] for r in found.collect()} == bad
    short = warc.tree(placed.filter("ordinal < 600"), fan_out=4)
    missing = {r["node"] for r in warc.audit(one, short, fan_out=4).collect()}
    assert missing == set(range(600, n + 2))
    assert warc.audit(warc.tree(placed.limit(0)), warc.tree(placed.limit(0))).isEmpty()


CONVERSATIONS = [
    (1, 0, "system", "be kind"), (1, 1, "user", "hi \\### User: </turn>"), (1, 2, "assistant", "yo"),
    (2, 1, "assistant", "first"), (2, 0, "user", None), (2, 1, "assistant", "first"),
    (3, 0, "user", "###\\"), (3, 1, "assistant", "</turn></turn>\n### "), (3, None, "user", ""),
    (4, 0, "to:ol", "x"), (4, 1, None, "y"), (4, 2, "=user", "z" * 70_000),
    (None, 0, "user", "a"), (None, 1, "assistant", "é🙂"),
]


def test_conversations_are_read_back(spark):
    rows = [(*r, "other", 1) for r in CONVERSATIONS]
    schema = "conv_id long, turn long, role string, text string, segments string, valid int"
    formatted = chat.format_chat(spark.createDataFrame(rows, schema).repartition(3))
    got = {r["conv_id"]: r for r in chat.read_back(formatted).collect()}
    by_conv = defaultdict(list)
    for conv, turn, role, text in CONVERSATIONS:
        by_conv[conv].append((-1 if turn is None else turn, role or "", text or ""))
    template = chat.Template()
    whole = defaultdict(str)
    for r in sorted(formatted.collect(), key=lambda r: (str(r["conv_id"]), r["position"])):
        whole[r["conv_id"]] += "".join(s["text"] for s in r["segments"])
    for conv, turns in by_conv.items():
        turns.sort()
        assert template.read(whole[conv]) == [(r, t) for _, r, t in turns]
        told = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        lost = "".join(t for _, r, t in turns if r == "assistant")
        row = got[conv]
        assert row["n_turns"] == len(turns)
        assert row["turns_sha256"] == hashlib.sha256(told.encode()).hexdigest()
        assert row["loss_chars"] == len(lost)
        assert row["loss_sha256"] == hashlib.sha256(lost.encode()).hexdigest()
        assert row["formatted_chars"] == len(whole[conv])
    valid = {c: r["valid"] for c, r in got.items()}
    assert valid == {1: True, 2: False, 3: False, 4: False, None: True}
    assert chat.read_back(formatted.limit(0)).isEmpty()


@needs_tables
@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_agrees_with_sql(spark, name):
    db = oracle.connect(FOLDER)
    assert oracle.compare(spark, db, FOLDER, queries.QUERIES[name], queries.ORACLES[name]) is None


@needs_tables
@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLES)))
def test_query_gives_a_row_for_each_input_row(spark, name):
    frame = queries.QUERIES[name](spark, FOLDER)
    source = {"op3_html_extraction": "pages", "op5_chat_format": "conversations"}.get(name, "documents")
    given = queries.table(spark, FOLDER, source)
    n = given.select("conv_id").distinct().count() + 1 if source == "conversations" else given.count()
    assert frame.count() == n


@needs_tables
def test_pipeline_stages(spark):
    docs = queries.table(spark, FOLDER, "documents")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, FOLDER), name)
        assert docs.columns == columns
        assert docs.count() <= before
        before = docs.count()
    got = corpus_pipeline.run(spark, FOLDER)
    assert got.count() == before > 0


@needs_tables
def test_pipeline_of_nothing(spark):
    docs = queries.table(spark, FOLDER, "documents").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, FOLDER), name)
        assert docs.isEmpty()
