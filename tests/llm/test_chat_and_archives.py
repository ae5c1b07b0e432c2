import gzip
import hashlib
import io
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rivermill.llm import arc, chat, queries

TURNS = "conv_id LONG, turn INT, role STRING, text STRING"


def shown(turns):
    escape = lambda s: (s or "").replace("\\", "\\\\").replace("<|", "<\\|")
    text = mask = ""
    for _, role, body in turns:
        head, tail = f"<|{escape(role if role is not None else 'none')}|>\n", escape(body) + "<|end|>\n"
        text += head + tail
        mask += "0" * len(head) + ("1" if role == "assistant" else "0") * len(tail)
    return text, mask


def by_hand(chosen, rejected):
    out = {}
    for key in {r[0] for r in chosen + rejected}:
        order = lambda t: ((t[0] is not None, t[0] or 0), (t[1] is not None, t[1] or ""), (t[2] is not None, t[2] or ""))
        c, r = (sorted({x[1:] for x in side if x[0] == key}, key=order) for side in (chosen, rejected))
        n = 0
        while n < min(len(c), len(r)) and c[n] == r[n]:
            n += 1
        out[key] = (shown(c[:n])[0], n, *shown(c[n:]), *shown(r[n:]))
    return out


def test_pairs_equal_brute_force(spark):
    chosen = [
        (1, 0, "system", "Be brief."), (1, 1, "user", "Hi"), (1, 2, "assistant", "Hello <|end|>\n<|user|>\\"), (2, 0, "user", "only chosen"), (3, 1, "assistant", None), (3, 0, None, "x"),
        (3, 0, None, "x"), (4, 0, "user", "same"), (None, None, "user", "no key"), (5, 0, "user", "é😀"), (5, 1, "assistant", "long " * 20000),
    ]
    rejected = [(1, 0, "system", "Be brief."), (1, 1, "user", "Hi"), (1, 2, "assistant", "No."), (1, 3, "user", "Why?"), (1, 4, "assistant", ""), (3, 0, None, "x"), (4, 0, "user", "same"), (6, 0, "user", "only rejected"), (5, 0, "user", "é😀!")]
    frame = lambda rows: spark.createDataFrame(rows, TURNS).withColumn("_key", F.lit("clash"))
    got = {r.conv_id: (r.prompt, r.n_common, r.chosen, r.chosen_mask, r.rejected, r.rejected_mask) for r in chat.format_preferences(frame(chosen), frame(rejected)).collect()}
    assert got == by_hand(chosen, rejected)
    assert got[4][1:] == (1, "", "", "", "") and all(len(g[2]) == len(g[3]) and len(g[4]) == len(g[5]) for g in got.values())


def test_no_turns(spark):
    empty = spark.createDataFrame([], TURNS)
    assert chat.format_preferences(empty, chat.swapped_answers(empty)).count() == 0


def test_swapped_answers_change_the_last_answer_only(spark):
    turns = [(0, 0, "user", "q"), (0, 1, "assistant", "first"), (0, 2, "assistant", "zero"), (1, 0, "assistant", "one"), (2, 0, "assistant", "alone"), (3, 0, "user", "no answer")]
    got = chat.swapped_answers(spark.createDataFrame(turns, TURNS)).collect()
    assert Counter(map(tuple, got)) == Counter([(0, 0, "user", "q"), (0, 1, "assistant", "first"), (0, 2, "assistant", "one"), (1, 0, "assistant", "zero"), *turns[4:]])


def test_names_of_further_columns_do_not_matter(spark, tmp_path):
    turns = [(k, t, ("user", "assistant")[t % 2], f"text {k} {t}") for k in range(6) for t in range(4)]
    plain = spark.createDataFrame(turns, TURNS)
    clash = plain.withColumns({c: F.lit("x") for c in ("_turn", "_own", "_lent", "_to", "_key", "_turns", "_c", "_r", "_last")})
    plain.write.parquet(str(tmp_path / "plain" / "conversations.parquet"))
    clash.write.parquet(str(tmp_path / "clash" / "conversations.parquet"))
    one, other = (queries.chat_formatting(spark, str(tmp_path / d)) for d in ("plain", "clash"))
    assert Counter(one.collect()) == Counter(other.collect()) and one.count() == 6


PAGES = [
    (1, "http://a/x", "<p>" + "copy" * 40), (2, "http://b/ y\n", "<p>" + "copy" * 40), (3, None, None), (4, "http://c", ""), (5, "http://d", "short"), (6, "http://e", "short"),
    (7, "http://f", "WARC/1.1\r\n\r\n\r\nHTTP/1.1 200 OK\r\n\r\nhttp://z 0.0.0.0 20200101000000 text/html 5\n" * 3), (8, "http://g", "é日😀" * 30000), (2, "http://b/ y\n", "<p>" + "copy" * 40),
]


def test_archive_query_equals_brute_force(spark, tmp_path):
    spark.createDataFrame(PAGES, "page_id LONG, url STRING, html STRING").repartition(3).write.parquet(str(tmp_path / "pages.parquet"))
    got = queries.warc_conversion(spark, str(tmp_path)).collect()
    first, want = {}, []
    for i, _, html in sorted(PAGES, key=lambda p: p[0]):
        raw = (html or "").encode()
        held = first.get(raw) if len(raw) >= 100 else None
        want.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "response" if held is None else "revisit", held))
        first.setdefault(raw, i)
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == Counter(want)
    assert all(r.intact for r in got) and {r.url for r in got} >= {"http://b/%20y%0A", "urn:x-record:3"}


def test_archives_without_rows(spark, tmp_path):
    spark.createDataFrame([], "page_id LONG, url STRING, html STRING").write.parquet(str(tmp_path / "pages.parquet"))
    assert queries.warc_conversion(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("version", [1, 2])
def test_records_are_cut_by_declared_length(version):
    blocks = [b"", b"HTTP/1.0 404 Not Found\n\nhttp://x 1.1.1.1 20000101000000 text/html 3\nabc\n", bytes(range(256)), b"\n\n\n"]
    data = arc.version_block(version) + b"\n" + b"".join(arc.header_line(version, f"http://h/{k}", "20040229123456", "text/html", len(b)) + b + b"\n" for k, b in enumerate(blocks))
    got = list(arc.arc_records(io.BytesIO(data)))
    assert [g[3] for g in got] == blocks and {g[0] for g in got} == {version} and [g[2]["URL"] for g in got] == [f"http://h/{k}" for k in range(4)]
    assert all(data[g[1] :].startswith(g[2]["URL"].encode()) for g in got)


def test_broken_archives_are_told(tmp_path):
    whole = arc.version_block(1) + b"\nhttp://x 0.0.0.0 20040101000000 text/html 10\nabc"
    with pytest.raises(ValueError, match="ends early"):
        list(arc.arc_records(io.BytesIO(whole)))
    with pytest.raises(ValueError, match="no declared length"):
        list(arc.arc_records(io.BytesIO(arc.version_block(1) + b"\nhttp://x 0.0.0.0 20040101000000 text/html ten\n")))


def test_any_bytes_survive_and_dates_are_filled_up(spark, tmp_path):
    blob = bytes(range(256)) * 2
    (tmp_path / "in").mkdir()
    lines = arc.version_block(2) + b"\n" + arc.header_line(2, "dns:host", "200402", "text/dns", len(blob)) + blob + b"\n"
    (tmp_path / "in" / "a.arc.gz").write_bytes(gzip.compress(lines))
    records = arc.to_warc(arc.read_arc(spark, str(tmp_path / "in"), "X-Key"), F.col("record_key"))
    arc.write_warc(records, str(tmp_path / "out"))
    (path,) = (tmp_path / "out").glob("*.gz")
    (head, block), = arc.warc_records(gzip.open(path))
    assert block == blob and head["warc-type"] == "resource" and head["warc-date"] == "2004-02-01T00:00:00Z" and head["content-type"] == "text/dns"
    assert head["warc-payload-digest"] == "sha256:" + hashlib.sha256(blob).hexdigest()
