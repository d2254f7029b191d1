"""Groups, archives, url rules, tool calls, retrieval and the classifier on small frames."""

import json
import random
import re
import string

import pytest
import zstandard
from pyspark.sql import functions as F

from ledgerline.llm import warc
from ledgerline.llm.cotraining import CoTraining, co_train
from ledgerline.llm.graph import components
from ledgerline.llm.latent import Latent, common_subsequence, contaminated
from ledgerline.llm.neardup import NearDup, near_duplicates
from ledgerline.llm.store import scratch, write_file
from ledgerline.llm.toolcalls import blocks, canonical_json, fault, linked_calls, ordered
from ledgerline.llm.urls import UrlRule, judged_urls


def classes(nodes, pairs):
    up = {n: n for n in nodes}

    def root(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in pairs:
        x, y = sorted((root(a), root(b)))
        up[y] = x
    return {n: root(n) for n in nodes}


def test_components_match_union_find(spark):
    rng = random.Random(5)
    pairs = [(rng.randint(0, 80), rng.randint(0, 80)) for _ in range(60)] + [(i, i + 1) for i in range(100, 140)] + [(200, i) for i in range(201, 240)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(pairs, "a long, b long"), "a", "b").collect()}
    want = classes({n for p in pairs if p[0] != p[1] for n in p}, [p for p in pairs if p[0] != p[1]])
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def near_rows():
    rng = random.Random(8)
    rows = [(0, None), (1, ""), (2, "one two"), (3, "ONE  two"), (4, " \n"), (5, "one two three")]
    for source in range(3):
        base = [rng.choice(string.ascii_letters) + str(rng.randint(0, 500)) for _ in range(70)]
        for _ in range(18):  # copies of copies: some pairs are just over the limit, some just under
            own = [w if rng.random() > rng.choice([0.005, 0.02, 0.05]) else "x" + str(rng.random()) for w in base]
            rows.append((len(rows), " ".join(own)))
    rows += [(len(rows) + 5, rows[10][1]), (len(rows) + 9, rows[10][1].upper()), (len(rows) + 20, "y " * 3000)]
    return rows


@pytest.mark.parametrize("p", [NearDup(), NearDup(pairwise=1, block=5), NearDup(hubs=1, pairwise=1000)])
def test_near_duplicates_match_brute_force(spark, p):
    rows = near_rows()
    sets = {k: shingles(t) for k, t in rows}
    pairs = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    want = classes(sets, pairs)
    docs = spark.createDataFrame([(*r, 1, "c") for r in rows], "doc_id long, text string, key int, bucket string").repartition(5)
    got = near_duplicates(docs, p=p).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got} == {
        k: (len(s), want[k], want[k] == k) for k, s in sets.items()
    }


def test_near_duplicates_of_odd_rows(spark):
    docs = spark.createDataFrame([(None, "a b c d e f"), (7, "a b c d e f"), (7, "a b c d e f"), (9, "a b c d e f")], "doc_id long, text string")
    got = sorted((str(r["doc_id"]), r["component_id"], r["kept"]) for r in near_duplicates(docs).collect())
    assert got == [("7", 7, True), ("7", 7, True), ("9", 7, False), ("None", None, True)]
    assert near_duplicates(docs.limit(0)).count() == 0


def test_archives(spark):
    rows = [(k, f"http://x/{k}", "same body" if k % 3 else f"body {k} é" * (k + 1)) for k in range(60)] + [(None, None, None), (70, "a\nb", None), (1, "http://again", "same body")]
    pages = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, digest string")
    got = warc.archived(pages, scratch(spark, "warc"), warc.ArchiveOptions(archive_bytes=400)).collect()
    assert len(got) == len(rows) and not [r for r in got if r["error"]]
    by = {r["url"]: r for r in got}
    assert (by["http://x/1"]["record_type"], by["http://again"]["record_type"], by["http://x/4"]["refers_to"]) == ("response", "response", 1)
    assert by["http://x/2"]["payload_bytes"] == 9 and by["http://x/0"]["payload_bytes"] == len("body 0 é".encode())
    assert by["a%0Ab"]["payload_digest"] == "3I42H3S6NNFQ2MSVX7XZKYAYSCX5QBYJ"
    assert warc.archived(pages.limit(0), scratch(spark, "warc")).count() == 0


def test_archive_errors(spark):
    good = warc.record(1, "u", b"payload", "x", None, False, "d")
    assert warc.parse(good)[0]["error"] == "payload digest differs"
    assert "content length" in warc.parse(good + b"x")[0]["error"]
    assert "bad header" in warc.parse(b"nothing")[0]["error"]
    plain = zstandard.ZstdCompressor().compress(good)  # an archive without a dictionary
    assert list(warc.frames(plain + plain)) == [good, good]
    with pytest.raises(ValueError, match="cut"):
        list(warc.frames(plain[:-3]))
    folder = scratch(spark, "warc")
    write_file(folder, "a.warc.zst", plain)
    rows = warc.read_archives(spark.read.format("binaryFile").load(folder), payloads=True).collect()
    assert [(r["page_id"], r["error"]) for r in rows] == [(1, "payload digest differs")]


RULES = [UrlRule("block", "net/"), UrlRule("allow", "example.net/en/"), UrlRule("block", "example.com/de/"), UrlRule("allow", "org/fr/")]


def test_url_rules_and_aliases(spark):
    link = '<link rel="canonical" href="https://bad.net/page"><p>'
    refresh = '<meta http-equiv="refresh" content="0; url=https://a.example.com/de/x">'
    rows = [
        (1, "https://A.Example.NET/en/1?x", None), (2, "http://example.net/en", None), (3, "nothing", None), (4, None, ""),
        (5, "https://free.example.org/z", link), (6, "https://free.example.org/z#top", None), (7, "https://free.example.org/fr/z", link),
        (8, "http://mirror.org/q", refresh), (9, "http://mirror.org/q/", None), (10, "http://notexample.com/de/1", None), (11, "http://net", None),
    ]
    pages = spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, node string, rule string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in judged_urls(pages, RULES).collect()}
    assert got == {
        1: ("a.example.net", "/en/1", "example.net/en/", "allow"), 2: ("example.net", "/en", "net/", "block"),
        3: ("", "", None, "allow"), 4: ("", "", None, "allow"),
        5: ("free.example.org", "/z", None, "block"), 6: ("free.example.org", "/z", None, "block"),
        7: ("free.example.org", "/fr/z", "org/fr/", "allow"), 8: ("mirror.org", "/q", None, "block"), 9: ("mirror.org", "/q/", None, "block"),
        10: ("notexample.com", "/de/1", None, "allow"), 11: ("net", "", None, "allow"),
    }
    assert judged_urls(pages.limit(0), RULES).count() == 0


def test_canonical_json_and_schemas():
    assert canonical_json({"b": [1.0, True, None], "a": {"é": 2.5}}) == '{"a":{"é":2.5},"b":[1,true,null]}'
    with pytest.raises(ValueError):
        canonical_json(float("nan"))
    schema = {"type": "object", "required": ["n"], "properties": {"n": {"type": "integer", "minimum": 1}}, "additionalProperties": False}
    cases = [({"n": 2}, None), ({"n": 2.0}, None), ({"n": True}, "type"), ({"n": 0}, "range"), ({}, "missing"), ({"n": 1, "m": 1}, "unknown"), ([], "type")]
    for value, bad in cases:
        assert (fault(value, schema) or "") == "" if bad is None else bad in fault(value, schema)


def test_order_of_calls(spark):
    calls = [(1, "a", 1, []), (1, "b", 2, ["d"]), (1, "c", 3, ["b"]), (1, "d", 9, ["a"]), (1, "e", 4, ["f", "gone"]), (1, "f", 5, ["e"]), (1, "g", 10, ["f"]), (2, "a", 1, ["a"])]
    df = spark.createDataFrame(calls, "conv_id long, call_id string, position long, depends_on array<string>")
    got = ordered(df).collect()
    assert len(got) == len(calls)
    rank = {(r["conv_id"], r["call_id"]): (r["order_at"], r["order_step"], r["position"]) for r in got}
    assert {k[1] for k, v in rank.items() if v[1] < 0 and k[0] == 1} == {"e", "f"} and rank[2, "a"][1] < 0
    for conv, call, _, after in calls:
        for dep in after:
            if (conv, dep) in rank and rank[conv, call][1] >= 0 and rank[conv, dep][1] >= 0:
                assert rank[conv, dep] < rank[conv, call]


def test_written_calls(spark):
    text = '<tool_call>{"id":"1","name":"add","arguments":{"y":2,"x":1.0}}</tool_call><tool_call>{"id":"2","name":"no","depends_on":["1"]}</tool_call><tool_call>oops</tool_call>'
    rows = [(1, 0, "assistant", text), (1, 1, "tool", '<tool_result>{"id":"1","content":3}</tool_result>'), (1, 2, "user", None), (None, 3, "user", text)]
    found = blocks(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = linked_calls(found.where("kind = 'call'"), found.where("kind = 'result'"), {"add": {"type": "object"}}).orderBy("call_id").collect()
    assert [(r["call_id"], r["status"]) for r in got] == [("1", "ok"), ("2", "invalid: $: no JSON")]
    assert json.loads(got[0]["record"]) == {"id": "1", "name": "add", "arguments": {"x": 1, "y": 2}, "result": 3, "status": "ok"}


def test_no_block_ends_the_job(spark):
    """Deep nesting, lone surrogates, huge numbers, NaN and lists of types: a status each."""
    deep = "[" * 200_000
    texts = [
        '<tool_call>' + deep + '</tool_call>',
        '<tool_call>{"id":"\\ud800","name":"add","arguments":{}}</tool_call>',
        '<tool_call>{"id":"s","name":"add","arguments":{"x":"\\ud800"}}</tool_call>',
        '<tool_call>{"id":"n","name":"\\udfff","arguments":{},"depends_on":["\\ud800",3,"s"]}</tool_call>',
        '<tool_call>{"id":"h","name":"whole","arguments":1' + "0" * 400 + '}</tool_call>',
        '<tool_call>{"id":"e","name":"add","arguments":1e999}</tool_call>',
        '<tool_call>{"id":"m","name":"add","arguments":{"x":' + "[" * 900 + "]" * 900 + '}}</tool_call>',
        '<tool_call>{"id":"r","name":"add","arguments":{}}</tool_call><tool_result>{"id":"r","content":"\\ud800"}</tool_result>',
        '<tool_call>{"id":"l","name":"either","arguments":null}</tool_call>',
        '<tool_call></tool_call>', "", None,
    ]
    df = spark.createDataFrame([(1, i, "user", t) for i, t in enumerate(texts)], "conv_id long, turn long, role string, text string")
    found = blocks(df)
    tools = {"add": {"type": "object"}, "whole": {"type": "integer", "minimum": 1}, "either": {"type": ["null", "string"]}}
    got = {r["call_id"]: r for r in linked_calls(found.where("kind = 'call'"), found.where("kind = 'result'"), tools).collect()}
    status = {k: r["status"] for k, r in got.items()}
    assert status.pop("m").startswith(("invalid: $: n", "no result"))
    assert status == {
        "s": "invalid: $: not Unicode", "n": "invalid: $: unknown tool", "h": "no result", "e": "invalid: $: not a JSON number",
        "r": "invalid: result $: not Unicode", "l": "no result",
    }
    assert all(json.loads(r["record"])["status"] == r["status"] for r in got.values())


def test_every_result_and_call_has_a_row(spark):
    calls = [(1, "a", 1, "add", "{}", []), (1, "a", 4, "add", "[]", None), (1, "a", 4, "add", "[]", None), (2, "a", 1, "add", "{}", []), (None, "a", 1, "add", "{}", [])]
    results = [(1, "a", 2, "1"), (1, "a", 3, "2"), (1, "a", 3, "2"), (1, "b", 5, "3"), (3, "a", 1, "4"), (3, "a", 2, "5"), (3, None, 2, "5")]
    made = spark.createDataFrame(calls, "conv_id long, call_id string, position long, name string, arguments string, depends_on array<string>")
    heard = spark.createDataFrame(results, "conv_id long, call_id string, position long, content string")
    got = linked_calls(made, heard, {"add": {"type": "object"}})
    assert sorted((r["conv_id"], r["call_id"], r["position"], r["status"], json.loads(r["record"]).get("result")) for r in got.collect()) == [
        (1, "a", 1, "ok", 1), (1, "a", 3, "repeated result", 2), (1, "a", 4, "repeated call", None), (1, "b", 5, "no call", 3),
        (2, "a", 1, "no result", None), (3, "a", 1, "no call", 4), (3, "a", 2, "repeated result", 5),
    ]
    assert linked_calls(made.limit(0), heard.limit(0), {}).count() == 0


def test_common_subsequence():
    rng = random.Random(2)
    for _ in range(200):
        a, b = ([rng.randint(0, 4) for _ in range(rng.randint(0, 12))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert common_subsequence(a, b) == table[-1][-1]


def test_decontamination_finds_planted_items(spark):
    rng = random.Random(6)
    words = ["".join(rng.choice(string.ascii_lowercase) for _ in range(rng.randint(2, 7))) for _ in range(900)]
    say = lambda n: " ".join(rng.choice(words[:40] if rng.random() < 0.4 else words) for _ in range(n))
    items = [(i, say(rng.randint(15, 50))) for i in range(20)] + [(50, None), (51, "")]
    rows, planted = [], {}
    for k in range(300):
        text = say(rng.randint(30, 400))
        if k % 10 == 0:
            i = rng.randrange(20)
            own = items[i][1].upper() if k % 20 else items[i][1]
            text, planted[k] = text + "\n" + own + " " + say(rng.randint(0, 90)), i
        rows.append((k, text))
    rows += [(400, None), (401, ""), (None, items[0][1])]
    docs = spark.createDataFrame([(*r, 1, "q") for r in rows], "doc_id long, text string, item long, key string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = contaminated(docs, bench, p=Latent(features=4096, rank=64)).collect()
    assert len(got) == len(rows)
    assert {r["doc_id"]: r["items"] for r in got if r["contaminated"]} == {k: [i] for k, i in planted.items()}
    assert contaminated(docs.limit(0), bench).count() == 0
    assert contaminated(docs, bench.limit(0)).where("contaminated").count() == 0


def test_co_training_on_held_out_rows(spark):
    rng = random.Random(1)
    rows, labels = [], []
    for k in range(900):
        kind = rng.choice(["fine", "fine", "fine", "junk", "toxic"])
        words = ["w" + str(rng.randint(0, 800)) for _ in range(rng.randint(30, 120))]
        words = ["".join(rng.choice(string.ascii_lowercase) for _ in range(4)) for _ in words]
        if kind == "toxic":
            for _ in range(4):
                words[rng.randrange(len(words))] = rng.choice(["vilest", "vilely", "nasty"])
        if kind == "junk":
            words = [w + "%%%" for w in words]
        rows.append((k, " ".join(words), "en", "src1", 500, 7, kind))
        if k < 600:
            labels.append((k, int(kind != "junk"), int(kind == "toxic")))
    docs = spark.createDataFrame([*rows, (None, None, None, None, None, 1, "odd")], "doc_id long, text string, lang string, source string, n_chars long, score int, kind string")
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    p = CoTraining(rounds=1, iterations=30)
    scored = co_train(docs, known, p=p).scored(docs)
    right = scored.where("row.doc_id >= 600").select((F.col("kept") == (F.col("row.kind") == "fine")).cast("int").alias("ok"))
    assert scored.count() == 901 and right.agg(F.avg("ok")).first()[0] > 0.97
    blind = co_train(docs, known.limit(0), p=p).scored(docs)
    assert blind.where("kept").count() == 901
    assert co_train(docs, known, p=p).scored(docs.limit(0)).count() == 0
