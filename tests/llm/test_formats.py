import random
import struct

import duckdb
import pyarrow as pa
import pytest
import zstandard
from compare import differences

from txnmill.llm import chat, warc
from txnmill.session import new_path

PAGES = "page_id long, url string, html string"


def pages(n=60):
    rng = random.Random(5)
    rows = [(i, f"http://host{i % 7}/p{i}", "<html>" + " ".join(rng.choices(["alpha", "beta", "gämma", "<p>", "delta"], k=rng.randrange(0, 300))) + "</html>") for i in range(n)]
    rows += [(100 + i, "u", "same payload") for i in range(5)] + [(200, None, None), (201, "u", ""), (202, "bad\r\nurl", "x"), (203, "u", "y" * 700_000), (204, "u", "\r\n\r\nWARC/1.1\r\n")]
    return rows


def on_duck(name, table, sql):
    con = duckdb.connect()
    con.register(name, table)
    return con.execute(sql).to_arrow_table()


COLUMNS = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


def test_round_trip_equals_sql(spark):
    rows = pages()
    out = warc.round_trip(spark.createDataFrame(rows, PAGES).repartition(3)).select(*COLUMNS).toArrow()
    table = pa.table({"page_id": pa.array([r[0] for r in rows]), "html": pa.array([r[2] for r in rows])})
    assert differences(out, on_duck("pages", table, warc.oracle())) == []


def test_payloads_come_back_whole(spark):
    rows = pages()
    folder = new_path(spark, "archives")
    warc.write(warc.with_references(spark.createDataFrame(rows, PAGES).coalesce(2)), folder)
    out = warc.read(spark, folder).collect()
    text = {r[0]: (r[2] or "").encode() for r in rows}
    stored = {r["page_id"]: bytes(r["payload"]) for r in out if r["record_type"] == "response"}
    assert len(out) == len(rows) and all(stored[k] == text[k] for k in stored)
    assert all(text[r["refers_to"]] == text[r["page_id"]] for r in out if r["record_type"] == "revisit")
    found = spark.read.format("binaryFile").load(folder).select("content").collect()
    magics = {struct.unpack_from("<I", bytes(r["content"]))[0] for r in found if len(r["content"])}
    assert magics == {warc.DICTIONARY_FRAME}


def test_large_pages_and_several_archives_per_task(spark, tmp_path, monkeypatch):
    """A task holds few payloads whatever their size, and rolls to a new archive with a dictionary of its own."""
    monkeypatch.setattr(warc, "HELD", 100_000)
    monkeypatch.setattr(warc, "ROLL", 50_000)
    rng = random.Random(6)
    pages = {i: "".join(rng.choice("abcdefgh <>") for _ in range(60_000 if i % 5 == 0 else 3000)) for i in range(40)}
    rows = [(i, f"http://x/{i}", t) for i, t in pages.items()]
    folder = str(tmp_path / "archives")
    warc.write(warc.with_references(spark.createDataFrame(rows, PAGES).coalesce(1)), folder)
    out = warc.read(spark, folder).collect()
    assert {int(r["page_id"]): bytes(r["payload"]).decode() for r in out} == pages
    assert len(list((tmp_path / "archives").glob("*.warc.zst"))) > 3 and not list((tmp_path / "archives").glob(".part-*[0-9]"))


def test_smaller_payloads_are_responses(spark):
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "long enough"), (4, "u", "long enough")]
    out = {r["page_id"]: (r["record_type"], r["refers_to"]) for r in warc.round_trip(spark.createDataFrame(rows, PAGES), least=5).collect()}
    assert out == {1: ("response", None), 2: ("response", None), 3: ("revisit", 4), 4: ("response", None)}


def test_repeated_and_null_ids_and_an_empty_table(spark):
    rows = [(5, "u", "t"), (5, "u", "t"), (None, "u", "t"), (None, "u", "only null"), (None, "u", "only null")]
    out = sorted(((r["page_id"], r["record_type"], r["refers_to"]) for r in warc.round_trip(spark.createDataFrame(rows, PAGES)).collect()), key=str)
    assert out == sorted([(5, "response", None), (5, "response", None), (None, "revisit", 5), (None, "response", None), (None, "response", None)], key=str)
    assert warc.round_trip(spark.createDataFrame([], PAGES)).count() == 0


def record(payload=b"hello", **changes):
    return warc._record("response", "1", "http://x", None, warc.digest(payload), len(payload), payload)


def test_reader_names_what_is_wrong():
    good = record()
    assert warc.unfold(good)["payload"] == b"hello"
    for bad, cause in [
        (good.replace(b"WARC/1.1", b"WARC/9.9"), "version"),
        (good.replace(b"WARC-Date", b"WARC-When"), "missing headers"),
        (good[:-1], "length is"),
        (good[:-4] + b"....", "end mark"),
        (good.replace(b"hello", b"hallo"), "digest"),
        (good.replace(b"WARC-Type: response", b"WARC-Type: other"), "type"),
        (good + good, "length is"),
    ]:
        with pytest.raises(ValueError, match=cause):
            warc.unfold(bad)
    packed = zstandard.ZstdCompressor().compress(good)
    assert [r for _, r in warc.Archive("a", packed + packed).records()] == [good, good]
    with pytest.raises(ValueError, match="cut off"):
        list(warc.Archive("a", packed[:-3]).records())
    with pytest.raises(ValueError, match="dictionary frame is cut off"):
        warc.Archive("a", struct.pack("<II", warc.DICTIONARY_FRAME, 99) + b"x")
    with pytest.raises(ValueError, match="not a frame"):
        list(warc.Archive("a", b"garbage here").records())


def test_compressed_dictionary():
    words = warc.train([f"record {i} with some words that repeat in all of them {i * 7}".encode() * 20 for i in range(40)], 2000)
    body = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(words)).compress(record())
    content = zstandard.ZstdCompressor().compress(words)
    assert [r for _, r in warc.Archive("a", struct.pack("<II", warc.DICTIONARY_FRAME, len(content)) + content + body).records()] == [record()]


TURNS = "conv_id long, turn long, role string, text string"


def turns():
    rng, rows = random.Random(4), []
    for c in range(60):
        opening = rng.choice(["hello", "hi", f"own {c}"])
        for t in range(rng.randrange(1, 8)):
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", opening if t == 0 else rng.choice(["yes", "no", "ä\nö", f"long {c} answer"])))
    rows += [(70, 0, None, "x"), (70, 1, "assistant", None), (70, None, "system", "first"), (70, 1, "assistant", None), (71, 0, "assistant", "a"), (71, 1, "assistant", "a"), (None, 0, "user", "hello"), (None, 1, "assistant", "z")]
    return rows


def test_preferences_equal_sql(spark):
    from pyspark.sql import functions as F

    rows = turns()
    out = chat.preferences(spark.createDataFrame(rows, TURNS)).withColumns({c: chat.mask_text(F.col(c)) for c in ("chosen_mask", "rejected_mask")})
    columns = list(zip(*rows, strict=True))
    table = pa.table({"conv_id": pa.array(columns[0], pa.int64()), "turn": pa.array(columns[1], pa.int64()), "role": pa.array(columns[2]), "text": pa.array(columns[3])})
    assert out.count() > 40
    assert differences(out.toArrow(), on_duck("conversations", table, chat.oracle())) == []


def test_prompt_and_masks(spark):
    pair = [([("user", "q"), ("assistant", "good"), ("user", "more")], [("user", "q"), ("assistant", "bad")], 1)]
    kind = "array<struct<role:string,text:string>>"
    row = chat.format_pairs(spark.createDataFrame(pair, f"chosen {kind}, rejected {kind}, prompt int")).first()
    assert row["n_common"] == 1 and row["prompt"] == "<|im_start|>user\nq<|im_end|>\n"
    marked = [row["chosen_text"][r["start"] : r["stop"]] for r in row["chosen_mask"]]
    assert marked == ["good<|im_end|>"]
    assert [row["rejected_text"][r["start"] : r["stop"]] for r in row["rejected_mask"]] == ["bad<|im_end|>"]


def test_equal_and_empty_conversations(spark):
    rows = [(c, 0, "user", "same") for c in (1, 2)]
    out = chat.preferences(spark.createDataFrame(rows, TURNS)).collect()
    assert [(r["chosen_id"], r["rejected_id"], r["n_common"], r["chosen_text"], r["chosen_mask"]) for r in out] == [(1, 2, 1, "", [])]
    assert chat.preferences(spark.createDataFrame([], TURNS)).count() == 0
