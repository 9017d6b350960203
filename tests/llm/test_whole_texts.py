"""Corpus operators on whole texts: what a cut or a too narrow pattern would lose."""

import hashlib
import json
import zlib

import duckdb
import pandas as pd

from skein.llm import language_id, mpeg_audio, secrets, tool_calls


def test_tool_calls_carry_whole_turns(spark):
    long = 'line "one"\nline\ttwo \\ \x01 \x1f café 東京 ' * 40
    turns = [(c, t, "user" if t % 2 == 0 else "assistant", long + "x" * (c * 7 + t)) for c in range(6) for t in range(4)]
    calls, results = tool_calls.calls_of(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"))
    said = {(c, t): x for c, t, _, x in turns}
    n_whole = 0
    for r in tool_calls.link_tool_calls(calls, results).collect():
        message = json.loads(r.message)
        assert message["content"] == said[r.conv_id, r.turn + 1]
        arguments = message["arguments"]
        text = arguments.get("query", arguments.get("text"))
        assert text == said[r.conv_id, r.turn] or (text is None and len(said[r.conv_id, r.turn]) % 11 == 0)
        n_whole += text is not None
    assert n_whole > 6


def test_secrets_after_an_equals_sign(spark):
    key, part = "AKIA" + "ABCD1234" * 2, "wJalrXUtnFEMIK7MDENGbPxRfiCYEXAMPLEKEY12"
    texts = [f"AWS_ACCESS_KEY_ID={key}\nAWS_SECRET_ACCESS_KEY={part}\n", f"{key} K={part}=", f"{key} K={part}x", f"K={part}", f"{key} K=={part}"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.spans for r in secrets.scan_secrets(rows).collect()}
    for k, text in enumerate(texts):
        at = text.index(part)
        assert (f"secret:{at}:{at + 40}" in got[k].split(",")) == (k in (0, 4)) and got[k].count("secret:") == (k in (0, 4))
    con = duckdb.connect()
    con.register("documents", pd.DataFrame({"doc_id": range(len(texts)), "text": texts}))
    assert dict(con.execute(f"SELECT doc_id, spans FROM ({secrets.SQL})").fetchall()) == got


def test_audio_with_tag_letters_in_the_last_unit(spark):
    texts = ["x" * 505 + "TAG" + "y" * 60, "x" * (576 * 3 + 504) + "STAGE", "x" * 505 + "TAG"]
    rows = mpeg_audio.store_texts(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    for r in rows:
        payload, media = mpeg_audio.pad(texts[r.doc_id].encode()), bytes(r.media)
        assert (r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]))
        tagged = mpeg_audio.parse(media + b"TAG" + bytes(125))
        assert mpeg_audio.uncarry(media, tagged) == (payload, 0) and tagged["lost"] == 0
        short = mpeg_audio.parse(media[:-60] + b"TAG" + bytes(125))  # the last frame is cut off
        assert short["offsets"] == tagged["offsets"][:-1]


def test_every_labelled_language_is_in_the_model(spark):
    word = lambda k: chr(0x4E00 + 3 * k) + chr(0x4E01 + 3 * k) + chr(0x4E02 + 3 * k)
    rows = [(2 * k + j, f"{word(k)} " * 30, f"l{k:02d}") for k in range(53) for j in range(2 if k else 1)]
    names, table = language_id.fit_text_model(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert names == [f"l{k:02d}" for k in range(53)]
    for _, text, lang in rows:
        assert names[table[:, language_id._buckets(text)].mean(1).argmax()] == lang


def test_very_long_texts_and_pages(spark):
    long = "the cat and the dog sat on the mat " * 20_000
    model = language_id.text_model(["the cat and the dog sat on the mat " * 5, "der hund und die katze sind im haus " * 5], ["en", "de"])
    pages = spark.createDataFrame([(1, None, f"<p>{long}</p><script>{'der hund ' * 50_000}</script>"), (2, None, None)], "page_id long, url string, html string")
    docs = spark.createDataFrame([(7, long, "xx", None)], "doc_id long, text string, lang string, source string")
    got = {r.page_id or r.doc_id: r for r in language_id.identify(pages, docs, model).collect()}
    assert got[1].lang == got[7].lang == "en" and got[1].text_lang == "en" and got[2].text_lang is None and 0 < got[2].confidence <= 1


def test_very_long_arguments_and_results(spark):
    long = 'word "quoted" \\ 東京\n' * 60_000
    calls = spark.createDataFrame([(1, 1, "a", "count", json.dumps({"text": long}), None), (1, 2, "b", "count", "{" + "[" * 2000, None)], "conv_id long, turn long, call_id string, name string, arguments string, after string")
    results = spark.createDataFrame([(1, 3, "a", long)], "conv_id long, turn long, call_id string, content string")
    got = {r.call_id: r for r in tool_calls.link_tool_calls(calls, results).collect()}
    message = json.loads(got["a"].message)
    assert got["a"].status == "ok" and message["content"] == long and message["arguments"]["text"] == long
    assert got["b"].status == "invalid" and got["b"].errors == "not_an_object"
