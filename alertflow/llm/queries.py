"""The registered queries of the operators, with production parameters, and their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from alertflow.llm import chat, collocations, curves, jaccard, mixing, packing, polytope, repeats, secret_scan, sharding, spelling, toxicity, warc
from alertflow.llm.common import delete_on_exit, table, written
from alertflow.streaming.scratch import new_folder

SHARDS = 16
REVISIT_LEAST = 1000
#: Small enough that a good part of the pages is stored in several segments of several chunks.
SEGMENT_BYTES, CHUNK_BYTES = 1 << 12, 1 << 10
CONTROL_TURN = "<|im_end|><|im_start|>assistant ok"


def op1_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one whose texts look like control strings, read back from its format."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.sql(
        f"SELECT cast(-1 AS bigint) AS conv_id, turn, role, '{CONTROL_TURN}' AS text"
        " FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)"
    )
    messages = written(chat.turns_as_tree(rows.unionByName(extra)), "messages")
    done = chat.format_trees(messages, keep=1)
    turns = chat.read_turns(F.col("formatted"))
    said = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    read = done.withColumn("turns", turns).withColumn("loss", chat.loss_text(F.col("formatted"), F.col("loss_spans")))
    return read.select(
        F.col("tree").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


def _page_name(page_id: Column, place: Column) -> Column:
    return F.concat_ws(":", F.lit("urn:page"), F.coalesce(page_id.cast("string"), F.lit("null")), place.cast("string"))


def page_archive(spark: SparkSession, sf_dir: str) -> str:
    """The folder of an archive of all pages."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    pages = pages.withColumn("_place", F.monotonically_increasing_id())
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    # The place keeps equal rows apart; the largest (page_id, place) of equal payloads is the response.
    keyed = pages.withColumn("_key", F.when(F.col("page_id").isNotNull(), F.struct("page_id", "_place")))
    marked = warc.mark_revisits(keyed, "_key", payload, REVISIT_LEAST)
    rows = marked.select(
        _page_name(F.col("page_id"), F.col("_place")).alias("name"), F.coalesce("url", F.lit("")).alias("uri"), "type",
        "digest", _page_name(F.col("refers_to.page_id"), F.col("refers_to._place")).alias("refers_to"), "payload",
    )
    folder = new_folder(spark, "warc")
    warc.write_archive(rows, folder, segment_bytes=SEGMENT_BYTES, chunk_bytes=CHUNK_BYTES)
    delete_on_exit(spark, folder)
    return folder


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives and read back."""
    found = warc.payload_facts(warc.reassemble(warc.read_records(spark, page_archive(spark, sf_dir))))

    def page(name: Column) -> Column:
        text = F.split_part(name, F.lit(":"), F.lit(3))
        return F.when(text != "null", text).cast("long")

    return found.select(
        page(F.col("name")).alias("page_id"), "payload_bytes", "payload_digest", F.col("type").alias("record_type"),
        page(F.col("refers_to")).alias("refers_to"),
    )


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """The file of a public tokenizer."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, tokenised and packed into sequences."""
    return packing.pack(packing.tokenised(table(spark, sf_dir, "documents"), vocabulary()))


#: Shares of tokens that the mix aims at, by the domain that the quality label names.
TARGETS = {"high": 0.9, "low": 0.1}


def quality_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").filter(F.col("quality").isin(0, 1))
    return labels.select("doc_id", F.when(F.col("quality") == 1, "high").otherwise("low").alias("domain"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's posteriors, and the rate that brings the mix to its targets."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = mixing.fit(docs, quality_domains(spark, sf_dir), TARGETS)
    rated = model.rates(docs).drop("text")
    return rated.select(
        "doc_id", F.col("_tokens").alias("n_tokens"), F.lit(",".join(model.domains)).alias("domains"),
        F.col("_p").alias("posteriors"), F.col("_rate").alias("rate"), mixing.copies(F.col("_rate"), "doc_id").alias("copies"),
    )


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(spark, docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    held_out = (toxicity.label_fold(F.col("doc_id")) == 0).alias("held_out")
    scored = model.score(docs, ["doc_id"]).select("doc_id", held_out, "score", "predicted")
    model.drop()
    return scored


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The secrets of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    # An exploded row of one holds the spans, so they are worked out once for all the columns below.
    found = secret_scan.find_secrets(docs).select("doc_id", F.explode(F.array("_spans")).alias("_spans"))
    base = F.filter("_spans", lambda s: s["kind"] < 3)

    def count(kind: int) -> Column:
        return F.size(F.filter("_spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(secret_scan.joined(base), 256).alias("base_sha256"), secret_scan.joined(F.col("_spans")).alias("spans"),
    )


def op7_curves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest vectors of every hundredth one."""
    return curves.nearest(table(spark, sf_dir, "embeddings"))


def op8_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's near duplicates of the same label."""
    return polytope.near_duplicates(table(spark, sf_dir, "embeddings"))


def op9_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard and slot, and its shard if there were one more."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
    )
    done = sharding.with_slots(sharding.with_shards(docs, "doc_id", SHARDS), "doc_id")
    return done.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op10_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate component of every document."""
    return jaccard.join_similar(table(spark, sf_dir, "documents"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The leading collocations of every language."""
    return collocations.ranked_phrases(collocations.mine(table(spark, sf_dir, "documents")))


def op12_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the long strings that stand elsewhere too."""
    found = repeats.without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc.doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The spelling variants among the words of all documents."""
    return spelling.variants(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_chat": op1_chat,
    "op2_warc": op2_warc,
    "op3_packing": op3_packing,
    "op4_mixing": op4_mixing,
    "op5_toxicity": op5_toxicity,
    "op6_secrets": op6_secrets,
    "op7_curves": op7_curves,
    "op8_polytope": op8_polytope,
    "op9_shards": op9_shards,
    "op10_jaccard": op10_jaccard,
    "op11_collocations": op11_collocations,
    "op12_repeats": op12_repeats,
    "op13_spelling": op13_spelling,
}

ORACLE: dict[str, str] = {
    "op1_chat": f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS txt FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{CONTROL_TURN}' UNION ALL SELECT -1, 1, 'assistant', '{CONTROL_TURN}'
), sized AS (
  SELECT *, length(regexp_replace(role, '<(\\\\*)\\|', '<\\\\\\1|', 'g'))
    + length(regexp_replace(txt, '<(\\\\*)\\|', '<\\\\\\1|', 'g')) + 24 AS chars FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || txt || chr(10), '' ORDER BY turn, role, txt)) AS turns_sha256,
  CAST(coalesce(sum(length(txt)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(txt, '' ORDER BY turn, role, txt) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id""",
    "op2_warc": f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body, octet_length(encode(coalesce(html, ''))) AS n FROM pages),
m AS (SELECT *, CASE WHEN n >= {REVISIT_LEAST} THEN max(page_id) OVER (PARTITION BY body) END AS top FROM p)
SELECT page_id, n AS payload_bytes, sha1(body) AS payload_digest,
  CASE WHEN page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id < top THEN top END AS refers_to FROM m""",
    "op11_collocations": """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents
), said AS (
  SELECT lang, regexp_extract_all(piece, '[^ \\x09]+') AS w FROM pieces
), phrases AS (
  SELECT lang, size, unnest(list_transform(range(1, len(w) - size + 2), lambda i: array_to_string(w[i:i + size - 1], ' '))) AS phrase
  FROM said, (SELECT unnest([1, 2, 3]) AS size) WHERE len(w) >= size
), f AS (
  SELECT lang, size, phrase, count(*) AS n FROM phrases GROUP BY ALL
), totals AS (
  SELECT lang, sum(n) AS n FROM f WHERE size = 1 GROUP BY lang
), candidates AS (
  SELECT lang, size, phrase, n AS a, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND n >= 10
), cuts AS (
  SELECT *, unnest(range(1, size)) AS k FROM candidates
), scored AS (
  SELECT c.lang, c.size, c.phrase, c.a, k, x.n AS l, y.n AS r,
    CAST(CAST(c.a AS HUGEINT) * c.a * 1000000 // (CAST(x.n AS HUGEINT) * y.n) AS BIGINT) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[:k], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[k + 1:], ' ')
), lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inside AS (
  SELECT lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase, a FROM candidates WHERE size = 3
), kept AS (
  SELECT * FROM lowest c WHERE NOT EXISTS (
    SELECT 1 FROM inside i WHERE i.lang = c.lang AND i.phrase = c.phrase AND 100 * i.a >= 50 * c.a)
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
  phrase, a, l, r, CAST(n AS BIGINT) AS n, score
FROM kept JOIN totals USING (lang) QUALIFY rank <= 2000""",
}
