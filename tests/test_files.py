from __future__ import annotations

import gzip
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from newsloom import schemas
from newsloom.operators import report
from newsloom.plans import jobs
from newsloom.profile import wordpress_site
from newsloom.sinks import files as sinks
from newsloom.sources import files as sources
from newsloom.sources.sitemaps import malformed_sitemaps, read_sitemaps

SITE = wordpress_site("https://news.example.com", "Example News")


def record(i, text="متن"):
    return {
        "id": i, "url": f"https://news.example.com/post-{i}/", "slug": f"post-{i}", "published_at": "2026-01-01T00:00:00",
        "modified_at": None, "title": "عنوان", "text": text, "excerpt": "", "categories": [1], "tags": [], "author_id": None,
        "source": "Example News",
    }


def lines(*records):
    return "".join(json.dumps(r, ensure_ascii=False) + "\n" for r in records).encode()


def test_blank_lines_and_absent_fields(spark, tmp_path):
    path = tmp_path / "all_urls.jsonl"
    path.write_text('{"url": "u1"}\n\n  \n{"url": "u2", "category_slug": "s", "category_name": "کھیل"}\n', encoding="utf-8")
    rows = sources.read_url_list(spark, str(path)).collect()
    assert [(r.url, r.category_name) for r in rows] == [("u1", None), ("u2", "کھیل")]


def test_multi_member_gzip(spark, tmp_path):
    (tmp_path / "articles_0000.jsonl.gz").write_bytes(gzip.compress(lines(record(1), record(2))) + gzip.compress(lines(record(3))))
    rows = sources.read_articles(spark, f"{tmp_path}/articles_*.jsonl.gz")
    assert sorted(r.id for r in rows.collect()) == [1, 2, 3]
    assert report.gzip_test(sources.read_file_bytes(spark, str(tmp_path))).first()[1:] == (True, 2, 3)


def test_first_complete_record_wins(spark, tmp_path):
    bad = b'{"id": 7, "text": "cut'
    (tmp_path / "articles_0000.jsonl").write_bytes(bad + b"\n" + lines(record(7, "second"), record(7, "third"), record(8)))
    out = jobs.merge_job(spark, str(tmp_path), f"{tmp_path}/out")
    rows = {r.id: r.text for r in sources.read_articles(spark, f"{tmp_path}/out/articles").collect()}
    assert rows == {7: "second", 8: "متن"}
    assert out.first().total_records == 2 and out.first().duplicates == 0


def test_first_file_wins_over_later_ones(spark, tmp_path):
    for i, text in enumerate(["first", "second"]):
        (tmp_path / f"articles_{i:04d}.jsonl.gz").write_bytes(gzip.compress(lines(record(1, text))))
    jobs.merge_job(spark, str(tmp_path), f"{tmp_path}/out")
    assert sources.read_articles(spark, f"{tmp_path}/out/articles").first().text == "first"


def test_malformed_lines_are_counted_and_kept_aside(spark, tmp_path):
    (tmp_path / "a.jsonl").write_bytes(lines(record(1)) + b"not json\n" + lines(record(2)))
    rows = sources.land_articles(spark, str(tmp_path))
    assert sources.drop_malformed(rows).count() == 2
    assert [r._corrupt_record for r in sources.malformed_lines(rows).collect()] == ["not json"]
    assert report.validation_report(rows, corrupt="_corrupt_record").first().malformed == 1


def test_truncated_gzip_is_reported_and_fails_a_full_read(spark, tmp_path):
    whole = gzip.compress(lines(*[record(i, "x" * 50 + str(i * 7919)) for i in range(3000)]))
    (tmp_path / "good.jsonl.gz").write_bytes(whole)
    (tmp_path / "cut.jsonl.gz").write_bytes(whole[: len(whole) // 2])
    (tmp_path / "junk.jsonl.gz").write_bytes(b"plain text")
    rows = {r.file_name: r.ok for r in report.gzip_test(sources.read_file_bytes(spark, str(tmp_path))).collect()}
    assert rows == {"good.jsonl.gz": True, "cut.jsonl.gz": False, "junk.jsonl.gz": False}
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        sources.read_articles(spark, f"{tmp_path}/cut.jsonl.gz").collect()


def test_file_checksums(spark, tmp_path):
    data = gzip.compress(b"abc\n")
    (tmp_path / "a.gz").write_bytes(data)
    row = report.file_checksums(sources.read_file_bytes(spark, str(tmp_path))).first()
    assert (row.bytes, row.md5, row.sha256) == (len(data), hashlib.md5(data).hexdigest(), hashlib.sha256(data).hexdigest())


def test_gzip_report_tells_equal_names_apart(spark, tmp_path):
    data = gzip.compress(b"abc\n")
    for folder, content in (("a", data), ("b", data[:-3])):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "part.gz").write_bytes(content)
    rows = report.gzip_report(sources.read_file_bytes(spark, str(tmp_path))).collect()
    found = {r.path.split("/")[-2]: (r.file_name, r.ok, r.bytes, r.md5, r.sha256) for r in rows}
    assert found == {
        folder: ("part.gz", ok, len(c), hashlib.md5(c).hexdigest(), hashlib.sha256(c).hexdigest())
        for folder, ok, c in (("a", True, data), ("b", False, data[:-3]))
    }


def test_shard_files(spark, tmp_path):
    df = spark.createDataFrame([record(i) for i in range(1203)], schemas.ARTICLES_ARCHIVE).coalesce(1)
    sinks.write_article_shards(df, f"{tmp_path}/s")
    stats = report.shard_stats(sources.read_articles(spark, f"{tmp_path}/s"))
    assert sorted(r.records for r in stats.collect()) == [203, 500, 500]
    assert [r.records for r in report.latest_shards(stats, 1).collect()] == [203]
    totals = report.shard_totals(stats).first()
    assert (totals.shards, totals.records) == (3, 1203)
    line = gzip.open(next((tmp_path / "s").glob("*.gz")), "rt", encoding="utf-8").readline()
    assert json.loads(line).keys() == record(0).keys() and "متن" in line and '"modified_at":null' in line


def test_numbered_shards_are_folders_in_order(spark, tmp_path):
    df = spark.createDataFrame([record(i) for i in reversed(range(1203))], schemas.ARTICLES_ARCHIVE)
    sinks.write_numbered_shards(df, f"{tmp_path}/s", "id")
    rows = spark.read.schema("id long, shard long").json(f"{tmp_path}/s").collect()
    assert all(r.shard == r.id // 500 for r in rows) and len(rows) == 1203


def test_parts_in_name_order_are_one_archive(spark, tmp_path):
    df = spark.createDataFrame([record(i) for i in range(400)], schemas.ARTICLES_ARCHIVE).repartition(6)
    sinks.write_single_archive(df, f"{tmp_path}/a", "id")
    joined = b"".join(p.read_bytes() for p in sorted((tmp_path / "a").glob("*.gz")))
    (tmp_path / "one.jsonl.gz").write_bytes(joined)
    ids = [json.loads(line)["id"] for line in gzip.open(tmp_path / "one.jsonl.gz", "rt", encoding="utf-8")]
    assert ids == list(range(400))
    sinks.write_single_archive(df, f"{tmp_path}/b", "id", one_file=True)
    assert len(list((tmp_path / "b").glob("*.gz"))) == 1


def test_sized_parts(spark, tmp_path):
    df = spark.createDataFrame([record(i, hashlib.sha256(str(i).encode()).hexdigest() * 20) for i in range(3000)], schemas.ARTICLES_ARCHIVE)
    sinks.write_article_shards(df, f"{tmp_path}/s")
    shards = sources.read_articles(spark, f"{tmp_path}/s")
    sinks.write_sized_parts(df.coalesce(1), f"{tmp_path}/p", shards, part_bytes=60_000)
    assert sinks.oversize_parts(spark, f"{tmp_path}/p", 60_000).count() == 0
    assert sources.read_articles(spark, f"{tmp_path}/p").count() == 3000
    assert sinks.oversize_parts(spark, f"{tmp_path}/p", 100).count() > 1


def test_sitemaps(spark, tmp_path):
    ns = 'xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"'
    good = f'<?xml version="1.0" encoding="UTF-8"?><urlset {ns}><url><loc>https://a/1?x=1&amp;y=2</loc><lastmod>2026</lastmod></url><url><loc></loc></url><url/></urlset>'
    index = f'<sitemapindex {ns}><sitemap><loc>https://a/post-sitemap1.xml</loc></sitemap><sitemap><loc>https://a/tag-sitemap.xml</loc></sitemap></sitemapindex>'
    (tmp_path / "good.xml").write_text(good)
    (tmp_path / "cut.xml").write_text(f"<urlset {ns}><url><loc>https://a/2</loc></url><url><loc>https://a/")
    (tmp_path / "index.xml").write_text(index)
    entries = read_sitemaps(spark, str(tmp_path))
    assert sorted((r.file, r.kind, r.loc) for r in entries.collect()) == [
        ("good.xml", "url", "https://a/1?x=1&y=2"),
        ("index.xml", "sitemap", "https://a/post-sitemap1.xml"), ("index.xml", "sitemap", "https://a/tag-sitemap.xml"),
    ]
    assert [r.loc for r in jobs.post_sitemap_list(entries).collect()] == ["https://a/post-sitemap1.xml"]
    text = spark.read.text(str(tmp_path), wholetext=True).select(F.col("_metadata.file_name").alias("file"), "value")
    assert [r.file for r in malformed_sitemaps(text).collect()] == ["cut.xml"]


def test_progress_documents(spark, tmp_path):
    path = tmp_path / "progress.json"
    assert sources.read_progress(spark, str(path)).count() == 0
    path.write_text(json.dumps({"completed_urls": ["a", "b", "a"], "failed_urls": ["c"], "total_saved": 2}, indent=1))
    assert sorted(r.url for r in sources.read_progress(spark, str(path)).collect()) == ["a", "b"]
    assert [r.url for r in sources.read_progress(spark, str(path), "failed_urls").collect()] == ["c"]
    row = sources.read_progress_counters(spark, str(path)).first()
    assert (row.total_saved, row.current_shard_idx, row.start_time) == (2, 0, None)
    pages = tmp_path / "pages.json"
    assert sources.read_done_pages(spark, str(pages)).count() == 0
    pages.write_text("[3, 1, 2, 3]")
    assert sorted(r.page for r in sources.read_done_pages(spark, str(pages)).collect()) == [1, 2, 3]
    pages.write_text("{broken")
    assert sources.read_done_pages(spark, str(pages)).count() == 0


def test_ledger_is_appended(spark, tmp_path):
    path = f"{tmp_path}/ledger"
    assert sources.read_ledger(spark, path).count() == 0
    row = spark.createDataFrame([("u", 0, None, 200, "ok")], schemas.LEDGER)
    sinks.append_ledger(row, path)
    sinks.append_ledger(row, path)
    assert sources.read_ledger(spark, path).count() == 2


def post(i, text="<p>body</p>"):
    return {"id": i, "date": "2026-01-01T00:00:00", "modified": "2026-01-01T00:00:00", "link": f"https://n/{i}/", "slug": str(i),
            "title": {"rendered": f"T{i}"}, "content": {"rendered": text}, "excerpt": {"rendered": ""}, "categories": [1], "tags": [], "author": 1}


def test_archive_job(spark, tmp_path):
    pages = tmp_path / "landed"
    pages.mkdir()
    (pages / "page_1.json").write_text(json.dumps([post(1), post(2, "first")]))
    (pages / "page_2.json").write_text(json.dumps([post(2, "later"), post(3, "")]))
    (pages / "page_3.json").write_text(json.dumps({"code": "rest_error"}))
    (pages / "page_4.json").write_text(json.dumps([post(9)]))
    done = spark.createDataFrame([(4,)], "page long")
    row = jobs.archive_job(spark, str(pages), f"{tmp_path}/out", SITE, done=done).first()
    assert (row.total_records, row.unique_ids, row.duplicates, row.empty_text) == (3, 3, 0, 1)
    got = {r.id: r.text for r in sources.read_articles(spark, f"{tmp_path}/out/articles").collect()}
    assert got == {1: "body", 2: "first", 3: ""}
    assert [(r.file, r.page) for r in sources.quarantined_pages(spark, str(pages)).collect()] == [("page_3.json", 3)]
    later = jobs.archive_job(spark, str(pages), f"{tmp_path}/later", SITE, start_page=2).first()
    assert later.unique_ids == 3


def test_discover_job_prefers_sitemaps(spark, tmp_path):
    ns = 'xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"'
    maps = tmp_path / "maps"
    maps.mkdir()
    urls = "".join(f"<url><loc>https://news.example.com/{p}/</loc></url>" for p in ("second-post", "first-post", "tag/x", "first-post"))
    (maps / "post-sitemap1.xml").write_text(f"<urlset {ns}>{urls}</urlset>")
    listing = lambda n: f'<h3 class="entry-title"><a href="https://news.example.com/listed-{n}/">x</a></h3>'
    pages = [("sports-2", 1, listing(1)), ("sports-2", 2, listing(1) + listing(2)), ("sehat", 1, listing(1))]
    listings = spark.createDataFrame(pages, schemas.LISTING_PAGES)
    found = jobs.discover_job(spark, f"{tmp_path}/u1", SITE, str(maps), listings)
    assert [r.url for r in found.orderBy("url").collect()] == [f"https://news.example.com/{p}/" for p in ("first-post", "second-post")]
    assert found.first().category_name == "unknown"
    (maps / "post-sitemap1.xml").write_text("<urlset")
    found = jobs.discover_job(spark, f"{tmp_path}/u2", SITE, str(maps), listings)
    assert sorted((r.url[-9:], r.category_name) for r in found.collect()) == [("listed-1/", "صحت"), ("listed-1/", "کھیل"), ("listed-2/", "کھیل")]


def test_page_job(spark, tmp_path):
    body = f'<h1 class="tdb-title-text">T</h1><div class="td-post-content">{"x" * 120}</div>'
    spark.createDataFrame([("u1", body), ("u2", body), ("u3", "")], schemas.PAGES).write.parquet(f"{tmp_path}/pages")
    urls = spark.createDataFrame([("u1", "s", "کھیل")], schemas.URL_LIST)
    done = spark.createDataFrame([("u2",)], "url string")
    jobs.page_job(spark, f"{tmp_path}/pages", f"{tmp_path}/out", SITE, url_list=urls, done=done)
    rows = sources.read_articles(spark, f"{tmp_path}/out/articles", schemas.ARTICLES_PAGE).collect()
    assert [(r.url, r.category, r.char_count) for r in rows] == [("u1", "کھیل", 120)]
    line = jobs.report_job(spark, f"{tmp_path}/out/articles", f"{tmp_path}/report", schemas.ARTICLES_PAGE).first()
    assert (line.total_records, line.chars_total) == (1, 121)


def test_option_bounds(spark):
    from newsloom.functions.urls import archive_request_manifest

    for per_page in (0, 101):
        with pytest.raises(ValueError):
            archive_request_manifest(spark, 1, SITE, per_page=per_page)


def test_progress_record_is_stamped(spark, tmp_path):
    summary = spark.createDataFrame([(3, 1)], "saved long, failed long")
    sinks.write_progress(summary, f"{tmp_path}/p")
    sinks.write_progress(summary, f"{tmp_path}/p")
    rows = spark.read.schema("saved long, failed long, last_saved_at timestamp").json(f"{tmp_path}/p").collect()
    assert len(rows) == 1 and rows[0].saved == 3 and rows[0].last_saved_at is not None


def test_same_file_names_in_two_folders(spark, tmp_path):
    for run, text in (("a", "first"), ("b", "second")):
        (tmp_path / run).mkdir()
        (tmp_path / run / "articles_0000.jsonl").write_bytes(lines(record(1, text), record(5 if run == "a" else 6)))
    jobs.merge_job(spark, f"{tmp_path}/[ab]", f"{tmp_path}/out")
    rows = {r.id: r.text for r in sources.read_articles(spark, f"{tmp_path}/out/articles").collect()}
    assert rows == {1: "first", 5: "متن", 6: "متن"}
