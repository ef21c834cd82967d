"""Packing, archives, page text and the pipeline: round trips and brute force."""

import base64
import hashlib
import random
import struct
import zlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import corpus, documents, empty, plain

from silverline.llm import html_text, packing, warc
from silverline.session import scratch_path


@pytest.fixture(scope="module")
def how():
    return packing.public_packing()


def whole_encoder(how):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(how.tokenizer)
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab1'sé𝒳 \n\t\r.-ß 　")), max_size=40) | st.text(max_size=40))
def test_split_encoding_equals_whole_encoding(text):
    settings_ = packing.public_packing()
    if not hasattr(test_split_encoding_equals_whole_encoding, "made"):
        test_split_encoding_equals_whole_encoding.made = (packing.encoder(settings_), whole_encoder(settings_))
    ours, whole = test_split_encoding_equals_whole_encoding.made
    ids = whole(text)
    assert ours(text) == struct.pack(f"<{len(ids)}I", *ids)


def test_added_tokens_are_tokens(spark, how):
    texts = ["x <|endoftext|> y", "<|endoftext|>", "<|endoftext|", "a  b", "plain words"]
    encode = whole_encoder(how)
    rows = packing.pieces(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), how).collect()
    want = [(k, 0, 0, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))) for k, ids in enumerate([*encode(t), 2] for t in texts)]
    assert plain(rows) == plain(want)
    assert len(encode(texts[1])) == 1


@given(st.integers(1, 50), st.integers(1, 400))
def test_cut_points(length, total):
    pieces = packing.cut_points(total, length)
    assert sum(n for _, n in pieces) == total and all(0 < n <= length for _, n in pieces)
    assert all(n == length for _, n in pieces[1:]) and (len(pieces) == 1) == (total <= length)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=80))
def test_best_fit_decreasing(lengths):
    rooms = []
    want = []
    for item in sorted(range(len(lengths)), key=lambda k: (-lengths[k], k)):
        fits = [r for r in rooms if r >= lengths[item]]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - lengths[item])
        else:
            rooms.append(40 - lengths[item])
        want = sorted(rooms)
    places = packing.best_fit_decreasing(lengths, 40)
    used = defaultdict(list)
    for size, (sequence, offset) in zip(lengths, places, strict=True):
        used[sequence].append((offset, size))
    assert sorted(40 - sum(n for _, n in part) for part in used.values()) == want
    for part in used.values():
        at = 0
        for offset, size in sorted(part):
            assert offset == at
            at += size


def test_packing(spark, how):
    small = packing.Packing(how.tokenizer, how.ranks, how.pattern, group_pieces=7)
    encode = whole_encoder(how)
    for settings_ in (how, small):
        rows = packing.pack(documents(spark), settings_).collect()
        by_doc = defaultdict(list)
        for row in corpus():
            ids = [*encode(row[1] or ""), 2]
            for number, (start, length) in enumerate(packing.cut_points(len(ids), 1024)):
                by_doc["want"].append((row[0], number, start, length, zlib.crc32(struct.pack(f"<{length}I", *ids[start : start + length]))))
        assert plain([tuple(r)[:5] for r in rows]) == plain(by_doc["want"])
        used = defaultdict(list)
        for row in rows:
            used[row["sequence_id"]].append((row["offset"], row["length"]))
        for part in used.values():
            assert sum(n for _, n in part) <= 1024
            assert [o for o, _ in sorted(part)] == [sum(n for o2, n in part if o2 < o) for o, _ in sorted(part)]
    total = sum(r["length"] for r in rows)
    best = {r["sequence_id"] for r in packing.pack(documents(spark), how).collect()}
    assert len(best) <= -(-total // 1024) * 1.2 + 1
    assert packing.pack(empty(spark), how).count() == 0
    joined = packing.sequences(packing.pack(documents(spark), how)).collect()
    assert sum(r["tokens"] for r in joined) == total


PAGES = "page_id long, url string, html string, digest string, size long, file string"


def test_archives(spark):
    inner = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 4\r\n\r\nabcd\r\n\r\n"
    rng = random.Random(4)
    html = ["", None, "one", "one", "é𝒳" * 400, f"x{inner}y", inner * 3, f"{inner}tail WARC/1.1\r\n", "WARC/1.1\r\n", "\r\n\r\n", "a\r\n\r\nWARC/1.1\r\n\r\n", "Content-Length: 9"]
    html += ["".join(rng.choice(["WARC/1.1\r\n", "\r\n", "z", inner, "Content-Length: 3\r\n"]) for _ in range(30)) for _ in range(20)]
    rows = [(k, f"http://x/{k}", text, "d", 1, "f") for k, text in enumerate(html)]
    rows += [(None, None, "one", "d", 1, "f"), (None, "u\r\nWARC/1.1\r\n", "lonely", "d", 1, "f"), (50, "u", "twice", "d", 1, "f"), (50, "u", "twice", "d", 1, "f"), (49, "u", "twice", "d", 1, "f"), (-3, "u", "one", "d", 1, "f")]
    largest = defaultdict(list)
    for page_id, _, text, *_ in rows:
        largest[text or ""] += [] if page_id is None else [page_id]
    want = []
    for page_id, _, text, *_ in rows:
        raw = (text or "").encode()
        top = max(largest[text or ""], default=None)
        kind = "response" if top is None or page_id == top else "revisit"
        want.append((page_id, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), kind, top if kind == "revisit" else None))
    path = scratch_path(spark, "archives")
    warc.write_archives(spark.createDataFrame(rows, PAGES).repartition(2), path, max_records=9)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("134217728", "700"):  # archives whole, and in many splits
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "1")
            assert plain(warc.read_archives(spark, path).drop("stated_digest").collect()) == plain(want)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_one_archive_of_many_records(spark):
    """A file of 100,000 records, in one split and in many: the chain is followed from run to run, about one a split."""
    from pyspark.sql import functions as F

    pages = spark.range(100_000).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.concat(F.lit("p"), (F.col("id") % 70_000).cast("string")).alias("html"))
    path = scratch_path(spark, "archives")
    warc.write_archives(pages.coalesce(1), path, max_records=1_000_000)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size, least in (("134217728", 1), ("1000000", 10)):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "1")
            placed = warc._with_offsets(warc._parsed(warc._segments(spark, path)))
            links = warc.runs(placed.withColumn("next", F.col("offset") + F.col("claimed")).filter("claimed is not null"))
            splits = links.select("file", "block").distinct().count()
            assert links.select("file", "head").distinct().count() == splits >= least
            got = warc.read_archives(spark, path)
            assert got.count() == 100_000 and got.filter("record_type = 'revisit'").count() == 30_000
            assert got.filter("payload_bytes is null or payload_digest <> stated_digest").count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_archives_of_no_pages(spark):
    path = scratch_path(spark, "archives")
    warc.write_archives(spark.createDataFrame([], PAGES), path)
    assert warc.read_archives(spark, path).count() == 0


def test_base32(spark):
    from pyspark.sql import functions as F

    got = spark.createDataFrame([(f"t{k}",) for k in range(50)], "t string").select("t", warc.base32_sha1(F.col("t")).alias("d")).collect()
    assert all(r["d"] == base64.b32encode(hashlib.sha1(r["t"].encode()).digest()).decode() for r in got)


ARTICLE = "<article><h1>T &amp; t</h1><p><b>First para with words &lt;here&gt;.<br><p>Second\n  para<br>of words.</p><ul><li>one<li>two</ul></article>"
MAIN = "T & t\nFirst para with words <here>.\nSecond para of words.\none\ntwo"


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (f"<!DOCTYPE html><html><head><title>x</title><style>p{{}}</style></head><body><nav><ul><li><a href=1>a</a></ul></nav><div class='ad'>buy this now</div>{ARTICLE}<footer>&copy; z</footer></body></html>", MAIN),
        (f"<body><script>var t='</p>';</script>{ARTICLE}<section id='comments'><p>{'nice words ' * 40}</p></section><form><p>{'fill ' * 90}</p></form>", MAIN),
        (f"<body><header>site words</header><div id=cookie-notice><p>{'we use ' * 60}</p></div><main>{ARTICLE}</main><aside>more</aside>", MAIN),
        ("<body><div id=c><section><p>aaa bbb ccc</p><p>ddd</p></section><section><p>eee fff</p><p>ggg</p></section></div>", "aaa bbb ccc\nddd\neee fff\nggg"),
        ("plain <i>text</i>\n  only", "plain text only"),
        ("", ""),
        (None, ""),
        ("<p>a<!-- <p>no --><p>b &eacute; &#x41;&amp;lt;", "a\nb é A&lt;"),
        ("<div hidden>x</div><p>seen words", "seen words"),
        ("5 < 6 and a <b>c</b> <", "5 < 6 and a c <"),
        ("<a href=\"x>y", "y"),  # a quote that stays open ends with the tag
    ],
)
def test_page_text(page, text):
    assert html_text.extract(page or "") == text


@pytest.mark.parametrize("name", ["layout has-sidebar", "no-banner", "with-comments", "social-news", "discussion"])
@pytest.mark.parametrize("inner", [ARTICLE, f"<main>{ARTICLE}</main>", ARTICLE.replace("article", "div")])
def test_page_text_in_a_wrapper_with_a_layout_name(name, inner):
    beside = "<div class='comments'><article><p>so</p></article></div><div class='sidebar'><p>other</p></div>" if "article" in inner else ""
    assert html_text.extract(f"<body><nav>n</nav><div class='{name}'><div>{inner}</div>{beside}</div><footer>f</footer>") == MAIN


def test_page_text_of_several_articles_and_of_none():
    part = "".join(f"<p>{'several words of text ' * 6}{k}</p>" for k in range(3))
    want = "\n".join(f"{'several words of text ' * 6}{k}" for k in range(3))
    links = "<ul>" + "".join(f"<li><a href={k}>go to {k}</a></li>" for k in range(20)) + "</ul>"
    many = "".join(f"<article><h2>Part {k}</h2>{part}</article>" for k in range(3))
    assert html_text.extract(f"<body>{many}{links}") == "\n".join(f"Part {k}\n{want}" for k in range(3))
    assert html_text.extract(f"<body><main><article>{part}</article><div>{part}</div>{links}</main>") == f"{want}\n{want}"
    assert html_text.extract(f"<body><div>{part}</div><div>{links}</div><div>{part}</div>") == f"{want}\n{want}"


def test_page_text_of_deep_and_broken_pages():
    assert html_text.extract("<div>" * 20000 + "deep") == "deep"
    assert html_text.extract("<p title='" * 3000) is not None
    assert html_text.extract("</p></div>" * 100 + "<p>x") == "x"


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("<>/pbdivarticle \"'=&;!-x")), max_size=120))
def test_any_markup_parses(page):
    html_text.extract(page)


def test_pages(spark):
    rows = [(1, "u", f"<body>{ARTICLE}", "d", 1, "f"), (None, None, None, "d", 1, "f"), (2, "u", "<p>x", "d", 1, "f"), (2, "u", "<p>x", "d", 1, "f")]
    got = html_text.main_text(spark.createDataFrame(rows, PAGES)).collect()
    assert plain(got) == plain([(1, "u", MAIN, len(MAIN)), (None, None, "", 0), (2, "u", "x", 1), (2, "u", "x", 1)])
    assert html_text.main_text(spark.createDataFrame([], PAGES)).count() == 0


def test_pipeline(spark):
    import corpus_pipeline
    from silverline.llm import decontamination, line_runs, near_text, quality

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "best_fit_packing"]
    kept = quality.keep_good(docs)
    lines = line_runs.with_length(line_runs.drop_repeated_lines(kept)).select(*docs.columns)
    near = near_text.keep_one_of_each(lines)
    clean = decontamination.drop_contaminated(near, spark.read.parquet(f"{sf}/benchmark.parquet"))
    want = {(r["doc_id"], r["text"]) for r in clean.collect()}
    encode = whole_encoder(packing.public_packing())
    rows = corpus_pipeline.run(spark, sf).collect()
    tokens = defaultdict(int)
    for row in rows:
        tokens[row["doc_id"]] += row["length"]
    assert tokens == {doc_id: len(encode(text or "")) + 1 for doc_id, text in want}
    for _, stage in corpus_pipeline.STAGES[:4]:
        assert stage(spark, docs.limit(0), sf).columns == docs.columns


def test_stages_keep_clashing_and_dotted_columns(spark):
    import corpus_pipeline

    rows = [(*row, 7, 8, "dot", "k") for row in corpus()]
    names = ["doc_id", "text", "lang", "key", "raw", "fp", "line", "removed", "rules", "row", "spans", "group"]
    docs = spark.createDataFrame(rows, [*names, "n_removed", "n_chars", "a.b", "carried_2"])
    sf = "/root/testdata/sf0.001"
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns, name
        assert {row["a.b"] for row in out.collect()} == {"dot"} and {row["n_removed"] for row in out.collect()} == {7}, name
