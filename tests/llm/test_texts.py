import gzip
import hashlib
import json
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from gleanery.llm import decontaminate, licenses, warc

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return ALNUM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_hits(text, items, width):
    words, hit, found = words_of(text), set(), set()
    for item, body in items:
        want = words_of(body)
        size = min(width, len(want))
        windows = {tuple(want[i : i + size]) for i in range(len(want) - size + 1)} if size else set()
        for i in range(len(words) - size + 1):
            if size and tuple(words[i : i + size]) in windows:
                hit.update(range(i, i + size))
                if item is not None:
                    found.add(str(item))
    return len(words), len(hit), sorted(found)


@pytest.fixture(scope="module")
def tainted(spark, make, odd_texts):
    rng = random.Random(6)
    vocabulary = [f"Wörd{i}" for i in range(30)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(3, 25)))) for i in range(12)]
    items += [(2, items[2][1]), (None, "lone secret phrase here"), (90, None), (91, ""), (92, items[3][1] + " tail")]
    rows = list(odd_texts)
    for i in range(40):
        body = [rng.choice(vocabulary) for _ in range(rng.randint(0, 60))]
        if i % 3 == 0:
            body[5:5] = [items[i % 12][1].upper(), "--", "lone, Secret\nphrase HERE"]
        rows.append(", ".join(body))
    rows.append(rows[10])
    return list(enumerate(rows)), items, spark.createDataFrame(items, "item_id long, text string")


def test_hits_equal_brute_force_in_one_block_or_many(make, tainted):
    rows, items, benchmark = tainted
    docs = make(rows).select("doc_id", "text", F.lit("old").alias("items"))
    for width, block_bytes in ((10, 1 << 20), (4, 200)):
        want = {i: brute_hits(t, items, width) for i, t in rows}
        got = decontaminate.scan(docs, benchmark, width, block_bytes).collect()
        assert {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in got} == want
        assert all(sum(e - s for s, e in r.spans) == r.n_hit for r in got)


def test_removal_of_documents_or_spans(make, tainted):
    rows, items, benchmark = tainted
    docs = make(rows)
    clean = {i for i, t in rows if brute_hits(t, items, 10)[1] == 0}
    assert {r.doc_id for r in decontaminate.decontaminate(docs, benchmark).collect()} == clean
    cut = decontaminate.decontaminate(docs, benchmark, "spans").collect()
    texts = dict(rows)
    for r in cut:
        if r.doc_id in clean:
            assert r.text == texts[r.doc_id]
        else:
            assert len(words_of(r.text)) == len(words_of(texts[r.doc_id])) - brute_hits(texts[r.doc_id], items, 10)[1]
    nothing = benchmark.where("false")
    assert decontaminate.scan(docs, nothing).where("n_hit > 0").count() == 0
    assert decontaminate.scan(docs.where("false"), benchmark).collect() == []
    with pytest.raises(ValueError):
        decontaminate.decontaminate(docs, benchmark, "words")


def brute_licenses(text, templates, threshold):
    words = words_of(text)
    places = sorted(
        (i, label)
        for phrase, label in licenses.PHRASES.items()
        for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    )
    base = sorted({label for _, label in places})
    from tests.llm.test_licenses import brute_runs

    similar, best = brute_runs(text or "", templates, threshold)
    labels = {*base, *similar}
    return (
        len(words), len(places), places[0][0] if places else None, places[-1][0] if places else None,
        ",".join(base), ",".join(sorted(labels)), 1.0 if places else best,
    )


def test_licenses_equal_brute_force(make, odd_texts):
    rng = random.Random(3)
    rows = odd_texts + [
        "MIT License, the mit\nlicense! emit license mit licenses",
        "apache  LICENSE mit license general public license GENERAL-public license",
        "x\nLicensed under CC BY-NC 4.0.\ny",
        "Licensed under CC BY-NC\n4.0",
    ]
    for _ in range(60):
        label, body = rng.choice(licenses.TEMPLATES)
        words = [w for w in body.split() if rng.random() < 0.92] + [rng.choice(PAD) for _ in range(rng.randint(0, 9))]
        rng.shuffle(words)
        rows.append("the of\n" + " ".join(words).upper() + "\nend")
    rows.append(rows[-1])
    docs = make(list(enumerate(rows)) + [(None, rows[-2])]).withColumn("labels", F.lit("old"))
    for threshold in (licenses.THRESHOLD, 0.5):
        got = licenses.scan(docs, threshold=threshold).collect()
        want = {i: brute_licenses(t, licenses.TEMPLATES, threshold) for i, t in [*enumerate(rows), (None, rows[-2])]}
        names = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
        assert len(got) == len(rows) + 1
        assert {r.doc_id: tuple(r[n] for n in names) for r in got} == want
    assert licenses.scan(docs.where("false")).collect() == []
    bare = licenses.scan(docs, templates=[]).collect()
    assert {r.doc_id: r.base_labels for r in bare} == {r.doc_id: r.labels for r in bare}


PAD = "under of the to license work version in and".split()


def test_license_join_runs_no_python(make):
    plan = licenses.scan(make(["mit license"]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan) and "CartesianProduct" not in plan


@pytest.fixture(scope="module")
def pages(spark):
    rng = random.Random(1)
    big = "<p>é</p>" * 300
    rows = [(i, f"http://x/{i}?a=b c\r\n", rng.choice([big, f"<b>{i}</b>" * 400, "tiny", None, "\r\n\r\nWARC/1.1\r\n" * 90])) for i in range(80)]
    rows[7] = (7, "u", big)
    rows += [(7, None, big), (None, "u", big), (200, "u", "x" * 999), (201, "u", "x" * 999), (202, "u", "y" * 1000), (203, "u", "y" * 1000)]
    return rows, spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("archive", F.lit(1))


def test_archives_give_back_every_page(spark, pages, tmp_path):
    rows, table = pages
    got = warc.archive_pages(table.repartition(3), str(tmp_path / "w")).collect()
    assert len(got) == len(rows)
    payloads = {}
    for i, _, html in rows:
        payloads.setdefault(i, (html or "").encode())
    heads = {}
    for i, _, html in rows:
        data = (html or "").encode()
        if len(data) >= warc.MIN_REVISIT:
            heads[data] = max(heads.get(data, -1), -1 if i is None else i)
    kinds = {}
    for r in got:
        data = payloads[r.page_id]
        assert (r.payload_bytes, r.payload_digest) == (len(data), hashlib.sha1(data).hexdigest())
        kinds.setdefault(data, []).append(r)
        if r.record_type == "revisit":
            assert r.refers_to == heads[data] and r.payload is None
        else:
            assert r.refers_to is None and r.payload == data
    for data, group in kinds.items():
        shared = len(data) >= warc.MIN_REVISIT
        assert sum(r.record_type == "response" for r in group) == (1 if shared else len(group))
        if shared:
            assert max((-1 if r.page_id is None else r.page_id) for r in group if r.record_type == "response") == heads[data]


def test_members_stand_alone_and_the_index_finds_them(spark, pages, tmp_path):
    rows, table = pages
    warc.archive_pages(table.repartition(2), str(tmp_path / "w")).count()
    assert not (tmp_path / "w" / "crawl").exists()
    seen = 0
    for archive in (tmp_path / "w" / "members").glob("*.warc.gz"):
        data = archive.read_bytes()
        entries = [json.loads(line) for line in archive.with_name(archive.name + ".idx").read_text().splitlines()]
        end = 0
        for e in entries:
            assert e["offset"] == end
            end += e["length"]
            record = zlib.decompress(data[e["offset"] : end], 31)
            ((headers, block),) = warc.parse(iter([record]))
            assert headers["WARC-Record-ID"] == f"<{e['record_id']}>" and len(block) == int(headers["Content-Length"])
        assert end == len(data)
        seen += len(entries)
        assert len(list(warc.parse(warc.inflate(archive.open("rb"))))) == len(entries)
        assert gzip.decompress(data).count(b"WARC-Record-ID") == len(entries)
    assert seen == len(rows)


def test_archives_roll_and_may_be_empty(spark, pages, tmp_path):
    _, table = pages
    records = warc.write_archives(table.coalesce(1), str(tmp_path / "r"), roll_bytes=20_000).collect()
    files = {r.archive for r in records}
    assert len(files) > 3 and len(records) == 86
    assert warc.archive_pages(table.where("false"), str(tmp_path / "none")).collect() == []
    with pytest.raises(ValueError):
        list(warc.parse(iter([b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc"])))
