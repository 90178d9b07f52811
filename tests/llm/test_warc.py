"""Archives written, read back, and held against the rules in plain Python."""

import glob
import gzip
import hashlib
import random

import pytest

from maskwright.llm.warc import (
    chunk_row, read_chunks, read_records, records, segments_of, warc_round_trip, write_archives,
)


def expected(pages, least=1000):
    best = {}
    for page, html in pages:
        data = (html or "").encode()
        if page is not None:
            best[data] = max(best.get(data, page), page)
    out = []
    for page, html in pages:
        data = (html or "").encode()
        kept = best.get(data)
        revisit = len(data) >= least and kept != page
        out.append((
            page, len(data), hashlib.sha1(data).hexdigest(),
            "revisit" if revisit else "response", kept if revisit else None,
        ))
    return sorted(out, key=repr)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def made_pages():
    rng = random.Random(5)
    texts = ["é\r\n\r\nWARC/1.1\r\n" * 90, "x" * 999, "y" * 1000, "", None, "𝄞<b>" * 3000, " \r\n" * 400]
    pages = [(i, f"http://h/{i}", rng.choice(texts)) for i in range(60)]
    pages += [(60, None, "z" * 5000), (61, "http://h/a\r\nX-Bad: 1 b", "z" * 5000), (None, "u", "z" * 5000)]
    return pages + [pages[0], pages[5]]


@pytest.mark.parametrize("chunk", [7, 1000, 1 << 16])
def test_round_trip(spark, tmp_path, chunk):
    pages = made_pages()
    df = spark.createDataFrame(pages, "page_id long, url string, html string").selectExpr(
        "*", "1 as digest", "2 as record_id", "3 as value"
    )
    got = warc_round_trip(df, str(tmp_path / "a"), chunk=chunk)
    assert rows(got) == expected([(p, h) for p, _, h in pages])


def test_segments_are_small_and_join_to_the_payload(spark, tmp_path):
    text = "aé𝄞\r\n" * 5000
    df = spark.createDataFrame([(1, "u", text)], "page_id long, url string, html string")
    write_archives(records(df, chunk=500), str(tmp_path / "a"), records_per_file=7)
    files = sorted(glob.glob(f"{tmp_path}/a/*.gz"))
    assert len(files) > 1
    chunks = {}
    for f in files:
        data = open(f, "rb").read()
        assert gzip.decompress(data).endswith(b"\r\n\r\n")
        for headers, block in segments_of(data):
            assert len(block) < 500 * 4 + 300
            row = chunk_row(headers, block)
            chunks[row[1]] = row[8]
    assert b"".join(chunks[k] for k in sorted(chunks)).decode() == text
    got = read_records(read_chunks(spark, str(tmp_path / "a"))).collect()
    assert [r.payload_digest for r in got] == [hashlib.sha1(text.encode()).hexdigest()]


def test_archives_of_many_members_and_damage(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "abc")], "page_id long, url string, html string")
    write_archives(records(df), str(tmp_path / "a"))
    data = b"".join(open(f, "rb").read() for f in glob.glob(f"{tmp_path}/a/*.gz"))
    assert len(list(segments_of(data + data))) == 2
    with pytest.raises(EOFError):
        list(segments_of(data[:-12]))
    broken = gzip.compress(gzip.decompress(data).replace(b"\r\n\r\nabc", b"\r\n\r\nabd"))
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "x.gz").write_bytes(broken)
    with pytest.raises(Exception, match="sha1"):
        read_records(read_chunks(spark, str(tmp_path / "b"))).collect()


def test_empty_table(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc_round_trip(df).count() == 0
