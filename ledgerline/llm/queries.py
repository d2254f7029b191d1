from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from ledgerline.llm.cotraining import co_train
from ledgerline.llm.latent import contaminated
from ledgerline.llm.neardup import near_duplicates
from ledgerline.llm.pieces import decode_pieces, encode_sampled
from ledgerline.llm.repair import read_shards, write_shards
from ledgerline.llm.repeats import quality_rules
from ledgerline.llm.resampling import Resampling, resampled
from ledgerline.llm.ring import Ring, ring_shards
from ledgerline.llm.store import scratch
from ledgerline.llm.suite import query, table
from ledgerline.llm.tokens import TokenCache, count_tokens
from ledgerline.llm.toolcalls import blocks, linked_calls
from ledgerline.llm.turns import damaged, digests, repaired
from ledgerline.llm.urls import TRACKERS, UrlRule, judged_urls
from ledgerline.llm.warc import archived

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
TOKEN_LIMIT = 1024


@query("op1_token_counts")
def op1(spark, sf):
    docs = table(spark, sf, "documents")
    counts = count_tokens(docs, BYTE_BPE, TokenCache(spark, scratch(spark, "token-cache")))
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


OP7 = """WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' '))) END AS s FROM w),
classes AS (SELECT doc_id, len(s) AS n, min(doc_id) OVER (PARTITION BY list_sort(s)) AS rep, s FROM sets),
items AS (SELECT doc_id, n, unnest(s) AS x FROM classes WHERE doc_id = rep AND n > 0),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM items a JOIN items b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
reach(root, node) AS (
  SELECT doc_id, doc_id FROM classes WHERE doc_id = rep UNION SELECT r.root, p.b FROM reach r JOIN pairs p ON r.node = p.a),
least AS (SELECT node, min(root) AS root FROM reach GROUP BY node)
SELECT c.doc_id, CAST(c.n AS BIGINT) AS n_shingles, CASE WHEN c.n = 0 THEN c.doc_id ELSE l.root END AS component_id,
  c.doc_id = CASE WHEN c.n = 0 THEN c.doc_id ELSE l.root END AS kept
FROM classes c JOIN least l ON l.node = c.rep"""


@query("op7_near_duplicates", OP7)
def op7(spark, sf):
    return near_duplicates(table(spark, sf, "documents"))


@query("op6_token_shards")
def op6(spark, sf):
    folder = scratch(spark, "token-shards")
    manifest = write_shards(table(spark, sf, "documents"), folder, BYTE_BPE, 50257)
    return read_shards(manifest, folder).withColumnRenamed("key", "doc_id")


@query("op10_quality_rules")
def op10(spark, sf):
    return quality_rules(table(spark, sf, "documents"))


URL_RULES = [
    UrlRule("block", "net/"),
    UrlRule("allow", "example.net/en/"),
    UrlRule("block", "example.com/de/"),
    UrlRule("allow", "org/fr/"),
]


def _parts(url: str) -> tuple[str, str]:
    host = f"translate(regexp_extract({url}, '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return host, f"regexp_extract({url}, '^.*?://[^/?#]*([^?#]*)', 1, 's')"


def _canonical(url: str) -> str:
    host, path = _parts(url)
    query = f"""list_filter(string_split(regexp_extract({url}, '^[^?#]*\\?([^#]*)', 1, 's'), '&'),
      lambda p: p <> '' AND NOT regexp_matches(p, '(?i)^(?:{TRACKERS})(?:=|$)'))"""
    return f"""CASE WHEN contains({url}, '://') THEN 'https://' || {host} || regexp_replace({path}, '(?i)(?:/index)?\\.html?$|/+$', '')
      || CASE WHEN len({query}) > 0 THEN '?' || array_to_string({query}, '&') ELSE '' END END"""


def _rule(url: str, field: str) -> str:
    host, path = _parts(url)
    fits = ", ".join(
        f"CASE WHEN ({host} = '{r.host}' OR ends_with({host}, '.{r.host}')) AND starts_with({path}, '{r.path}') "
        f"THEN {{'n': {len(r.rule)}, 'verdict': '{r.verdict}', 'rule': '{r.rule}'}} END"
        for r in URL_RULES
    )
    return f"list_max(list_filter([{fits}], lambda r: r IS NOT NULL)).{field}"


OP5 = f"""WITH RECURSIVE p AS (SELECT page_id, coalesce(url, '') AS url, html FROM pages),
named AS (
  SELECT url, unnest([
    regexp_extract(html, '<link\\b[^>]*\\brel\\s*=\\s*["'']?canonical\\b[^>]*\\bhref\\s*=\\s*["'']([^"''>]+)', 1, 'is'),
    regexp_extract(html, '<link\\b[^>]*\\bhref\\s*=\\s*["'']([^"''>]+)["''][^>]*\\brel\\s*=\\s*["'']?canonical\\b', 1, 'is'),
    regexp_extract(html, '<meta\\b[^>]*\\bhttp-equiv\\s*=\\s*["'']?refresh\\b[^>]*\\burl\\s*=\\s*["'']?([^"''>\\s]+)', 1, 'is')
  ]) AS link FROM p),
links AS (SELECT url, link FROM named WHERE contains(link, '://') AND contains(url, '://')),
edges AS (
  SELECT url AS a, {_canonical("url")} AS b FROM p WHERE contains(url, '://')
  UNION SELECT url, link FROM links UNION SELECT url, {_canonical("link")} FROM links),
ways AS (SELECT a, b FROM edges WHERE a <> b UNION SELECT b, a FROM edges WHERE a <> b),
reach(root, node) AS (SELECT a, a FROM ways UNION SELECT r.root, e.b FROM reach r JOIN ways e ON r.node = e.a),
labels AS (SELECT node, min(root) AS label FROM reach GROUP BY node),
blocked AS (SELECT DISTINCT label FROM labels WHERE {_rule("node", "verdict")} = 'block')
SELECT page_id, {_parts("url")[0]} AS host, {_parts("url")[1]} AS path, {_rule("url", "rule")} AS rule,
  coalesce({_rule("url", "verdict")}, CASE WHEN b.label IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict,
  coalesce(l.label, url) AS alias_of
FROM p LEFT JOIN labels l ON l.node = p.url LEFT JOIN blocked b ON b.label = l.label"""


@query("op5_url_filters", OP5)
def op5(spark, sf):
    return judged_urls(table(spark, sf, "pages"), URL_RULES)


@query("op8_warc_archives")
def op8(spark, sf):
    return archived(table(spark, sf, "pages"), scratch(spark, "archives"))


@query("op2_sampled_pieces")
def op2(spark, sf):
    encoded = encode_sampled(table(spark, sf, "documents"), PIECES)
    decoded = decode_pieces(encoded, PIECES, original="text")
    return decoded.select("doc_id", "n_pieces", "ids_crc32", F.length("decoded").alias("n_chars"), "lossless")


@query("op4_quality_classifier")
def op4(spark, sf):
    docs = table(spark, sf, "documents")
    scored = co_train(docs, table(spark, sf, "labels")).scored(docs)
    return scored.select("row.doc_id", "toxic_score", "word_score", "page_score", "score", "kept")


@query("op9_decontamination")
def op9(spark, sf):
    return contaminated(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


# The conversations hold no tool blocks: each user turn is a call of `reply`, the assistant's next turn its result, and a call
# depends on the user turn before.
REPLY = {
    "type": "object",
    "required": ["prompt", "turn"],
    "additionalProperties": False,
    "properties": {"prompt": {"type": "string", "minLength": 1, "maxLength": 2000}, "turn": {"type": "integer", "minimum": 0}},
}

OP3 = """WITH calls AS (
  SELECT conv_id, turn, text, row_number() OVER (PARTITION BY conv_id, turn ORDER BY to_json(text)) AS k
  FROM conversations WHERE role = 'user' AND conv_id IS NOT NULL AND turn IS NOT NULL),
heard AS (
  SELECT DISTINCT conv_id, turn - 1 AS turn, to_json(text) AS content FROM conversations
  WHERE role = 'assistant' AND conv_id IS NOT NULL AND turn IS NOT NULL AND text IS NOT NULL),
results AS (SELECT conv_id, turn, min(content) AS content FROM heard GROUP BY ALL),
lost AS (
  SELECT conv_id, turn, turn + 1 AS position, content, 'no call' AS status FROM results r ANTI JOIN calls c USING (conv_id, turn)
  UNION ALL SELECT h.conv_id, h.turn, h.turn + 1, h.content, 'repeated result' FROM heard h JOIN results r USING (conv_id, turn)
  WHERE h.content > r.content),
again AS (
  SELECT DISTINCT b.conv_id, b.turn, b.text FROM calls a JOIN calls b USING (conv_id, turn)
  WHERE a.k = 1 AND a.text IS DISTINCT FROM b.text),
judged AS (
  SELECT c.conv_id, c.turn, c.text, r.content, concat(c.conv_id, '-', c.turn) AS call_id,
    CASE WHEN c.text IS NULL THEN 'invalid: $.prompt: missing'
         WHEN NOT length(c.text) BETWEEN 1 AND 2000 THEN 'invalid: $.prompt: length ' || length(c.text)
         WHEN r.content IS NULL THEN 'no result' ELSE 'ok' END AS status
  FROM calls c LEFT JOIN results r USING (conv_id, turn) WHERE c.k = 1)
SELECT conv_id, call_id, turn AS position, turn AS order_at, CAST(0 AS INTEGER) AS order_step, status,
  '{"arguments":{' || CASE WHEN text IS NULL THEN '' ELSE '"prompt":' || to_json(text) || ',' END || '"turn":' || turn || '},"id":"' || call_id ||
  '","name":"reply"' || coalesce(',"result":' || content, '') || ',"status":"' || status || '"}' AS record
FROM judged
UNION ALL SELECT conv_id, concat(conv_id, '-', turn), position, position, CAST(0 AS INTEGER), status,
  '{"id":"' || conv_id || '-' || turn || '","result":' || content || ',"status":"' || status || '"}' FROM lost
UNION ALL SELECT conv_id, concat(conv_id, '-', turn), turn, turn, CAST(0 AS INTEGER), 'repeated call',
  '{"arguments":{' || CASE WHEN text IS NULL THEN '' ELSE '"prompt":' || to_json(text) || ',' END || '"turn":' || turn || '},"id":"' || conv_id || '-' || turn ||
  '","name":"reply","status":"repeated call"}' FROM again"""


@query("op3_tool_calls", OP3)
def op3(spark, sf):
    said = table(spark, sf, "conversations").select("conv_id", F.col("turn").alias("position"), "role", "text")
    written = blocks(table(spark, sf, "conversations")).withColumn("position", F.expr("position div 1048576"))
    call_id, before = F.concat_ws("-", "conv_id", "position"), F.concat_ws("-", "conv_id", F.col("position") - 2)
    calls = said.where("role = 'user'").select(
        "conv_id",
        call_id.alias("call_id"),
        "position",
        F.lit("reply").alias("name"),
        F.to_json(F.struct(F.col("text").alias("prompt"), F.col("position").alias("turn"))).alias("arguments"),
        F.when(F.col("position") >= 2, F.array(before)).otherwise(F.array().cast("array<string>")).alias("depends_on"),
    )
    asked = F.concat_ws("-", "conv_id", F.col("position") - 1)
    quoted = F.regexp_replace(F.to_json(F.struct("text")), r"^\{\"text\":|\}$", "")
    results = said.where("role = 'assistant' and text is not null").select("conv_id", asked.alias("call_id"), "position", quoted.alias("content"))
    calls = calls.unionByName(written.where("kind = 'call'").select(calls.columns))
    results = results.unionByName(written.where("kind = 'result'").select(results.columns))
    return linked_calls(calls, results, {"reply": REPLY})


RING = Ring(shards=24, points=128, load=1.0)

# CRC-32 byte by byte over a table of 256 remainders, and rounds of askers as a recursion over all keys.
CRC_TABLE = "list_transform(range(256), lambda n: list_reduce([n,0,0,0,0,0,0,0,0], lambda a, z: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END))"


def crc32_sql(hexed: str, crcs: str) -> str:
    """The unsigned CRC-32 of the bytes whose upper-case hex digits are given; crcs names the table of remainders."""
    each = f"list_transform(string_split(rtrim(regexp_replace({hexed}, '(..)', '\\1,', 'g'), ','), ','), lambda b: CAST(('0x' || b) AS BIGINT))"
    walk = f"list_reduce(list_prepend(4294967295, {each}), lambda a, b: xor(a >> 8, {crcs}[(xor(a, b) & 255) + 1]))"
    return f"CASE WHEN {hexed} = '' THEN 0 ELSE xor({walk}, 4294967295) END"


def _place(name: str) -> str:
    return f"CAST('0x' || substr(md5({name}), 1, 15) AS BIGINT)"


OP13 = f"""WITH RECURSIVE crcs AS (SELECT {CRC_TABLE} AS t),
d AS (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 8 AS size, hex(encode(coalesce(text, ''))) AS x,
    {_place("'key:' || doc_id")} AS here, {_place("'order:' || doc_id")} AS turn FROM documents),
points AS (
  SELECT s AS shard, {_place("'shard:' || s || ':' || p")} AS at_ FROM range({RING.shards}) a(s), range({RING.points}) b(p)),
caps AS (
  SELECT s AS shard, n // {RING.shards} + CASE WHEN s < n % {RING.shards} THEN 1 ELSE 0 END AS cap
  FROM range({RING.shards}) a(s), (SELECT count(*) AS n FROM d)),
state(round, doc_id, here, turn, shard) AS (
  SELECT 0, doc_id, here, turn, CAST(NULL AS BIGINT) FROM d
  UNION ALL (
  WITH held AS (SELECT shard, count(*) AS n FROM state WHERE shard IS NOT NULL GROUP BY shard),
  free AS (SELECT c.shard, c.cap - coalesce(h.n, 0) AS free FROM caps c LEFT JOIN held h ON h.shard = c.shard),
  nodes AS (SELECT p.at_, p.shard FROM points p JOIN free f ON f.shard = p.shard WHERE f.free > 0),
  next AS (SELECT s.doc_id, arg_min(n.shard, n.at_) AS shard FROM state s JOIN nodes n ON s.here <= n.at_ WHERE s.shard IS NULL GROUP BY s.doc_id),
  asked AS (
    SELECT s.*, coalesce(s.shard, n.shard, (SELECT arg_min(shard, at_) FROM nodes)) AS asks
    FROM state s LEFT JOIN next n ON n.doc_id = s.doc_id),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY asks, shard IS NULL ORDER BY turn) AS k FROM asked)
  SELECT r.round + 1, r.doc_id, r.here, r.turn, CASE WHEN r.shard IS NOT NULL OR r.k <= f.free THEN r.asks END
  FROM ranked r JOIN free f ON f.shard = r.asks WHERE EXISTS (SELECT 1 FROM state WHERE shard IS NULL))),
final AS (SELECT doc_id, turn, shard FROM state WHERE round = (SELECT max(round) FROM state))
SELECT f.doc_id, CAST(d.size AS BIGINT) AS size, {crc32_sql("d.x", "crcs.t")} AS text_crc32, 'rows' AS law,
  CAST(f.shard AS INTEGER) AS shard, row_number() OVER (PARTITION BY f.shard ORDER BY f.turn) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM final f JOIN d ON d.doc_id = f.doc_id, crcs"""


@query("op13_ring_shards", OP13)
def op13(spark, sf):
    placed = ring_shards(table(spark, sf, "documents"), RING)
    law = [F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard")]
    return placed.select(F.col("key").alias("doc_id"), "size", "text_crc32", *law, "slot", F.lit(None).cast("int").alias("grown_shard"))


RESAMPLING = Resampling(width=3, buckets=10_000, least_words=20, percent=5, seed=42)
LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP11 = f"""WITH crcs AS (SELECT {CRC_TABLE} AS t),
texts AS (
  SELECT kind, id, list_filter(string_split_regex(body, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w
  FROM (SELECT 'd' AS kind, doc_id AS id, {LOWERED} AS body FROM documents UNION ALL SELECT 'b', item_id, {LOWERED} FROM benchmark)),
runs AS (
  SELECT kind, id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: array_to_string(w[i:i+1], ' ')),
    list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i+2], ' ')))) AS f FROM texts),
counts AS (SELECT kind, id, f, count(*) AS n FROM runs GROUP BY ALL),
hexed AS (SELECT f, hex(encode(f)) AS x FROM (SELECT DISTINCT f FROM counts)),
hashed AS (SELECT f, {crc32_sql("x", "crcs.t")} % 10000 AS bucket FROM hexed, crcs),
found AS (SELECT kind, id, bucket, sum(n) AS n FROM counts JOIN hashed USING (f) GROUP BY ALL),
sizes AS (SELECT coalesce(sum(n) FILTER (kind = 'd'), 0) AS s, coalesce(sum(n) FILTER (kind = 'b'), 0) AS t FROM found),
each AS (SELECT bucket, sum(n) FILTER (kind = 'd') AS s, coalesce(sum(n) FILTER (kind = 'b'), 0) AS t FROM found GROUP BY bucket),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln(CAST((e.t + 1) * (z.s + 10000) AS DOUBLE) / CAST((e.s + 1) * (z.t + 10000) AS DOUBLE))) AS BIGINT) AS gain
  FROM each e, sizes z WHERE e.s IS NOT NULL),
sums AS (SELECT id, sum(n) AS n_features, sum(n * gain) AS weight FROM found JOIN gains USING (bucket) WHERE kind = 'd' GROUP BY id),
scored AS (
  SELECT id AS doc_id, len(w) AS n_words, CAST(coalesce(n_features, 0) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
    CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('42:' || id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM texts LEFT JOIN sums USING (id) WHERE kind = 'd'),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS k, count(*) OVER (PARTITION BY n_words >= 20) AS n FROM scored)
SELECT doc_id, n_words, n_features, weight, score, CASE WHEN n_words >= 20 AND k <= 5 * n // 100 THEN k END AS rank FROM ranked"""


@query("op11_resampling", OP11)
def op11(spark, sf):
    return resampled(table(spark, sf, "documents"), table(spark, sf, "benchmark"), p=RESAMPLING).withColumnRenamed("key", "doc_id")


@query("op12_conversation_repair")
def op12(spark, sf):
    rows = damaged(table(spark, sf, "conversations"))
    return digests(repaired(rows, names_only=F.col("dropped"))).withColumnRenamed("key", "conv_id")
