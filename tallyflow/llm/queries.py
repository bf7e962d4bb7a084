"""The numbered queries and the pipeline, over the given tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chunks, codebooks, common, decontam, hmm, packing, pii, quality, resample, sharding, sigtree, simhash, toolcalls, topk

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
CAPACITY = 2048
#: Taken from a secret store in production; pseudonyms stay linked for as long as it stays.
PII_KEY = "tallyflow-demo-key"


def sound_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`embeddings` with `e`, the vector as doubles, of rows whose vector is all finite numbers."""
    rows = common.table(spark, sf_dir, "embeddings").withColumn("e", F.col("embedding").cast("array<double>"))
    # What is not below infinity in size is infinite or no number.
    return rows.where("e is not null and forall(e, x -> x is not null and abs(x) < double('infinity'))")


def op1_pivot_distance_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = sound_vectors(spark, sf_dir).select(
        F.col("vec_id").cast("long").alias("id"),
        # A double below 2^63 has its floor in a long; larger ones would become another number.
        F.expr("transform(e, x -> if(abs(64 * x) < 9.2e18D, floor(64 * x), raise_error('op1: a component is too large')))")
        .cast("array<bigint>")
        .alias("v"),
        (F.col("vec_id") % 20 == 0).alias("asks"),
    )
    found = topk.top_k(vectors, k=20)
    return found.select(F.col("query").alias("query_id"), "rank", F.col("id").alias("vec_id"), "score")


def op2_hidden_markov_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    scored = hmm.score(docs, trains=common.crc_of_id() % 10 != 0)
    return scored.select(
        F.col("id").alias("doc_id"),
        (~F.col("trains")).alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
    )


def op3_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(common.table(spark, sf_dir, "documents"), TOKENIZER, RANKS, CAPACITY)
    return packed.withColumnRenamed("id", "doc_id")


#: The tools that conversations are read as calling: tool, field, type, required.
TOOLS = [
    ("search", "query", "string", True),
    ("search", "limit", "integer", True),
    ("search", "source", "object", False),
    ("lookup", "query", "string", True),
    ("lookup", "limit", "integer", False),
    ("lookup", "source", "object", False),
    ("compute", "query", "string", True),
    ("compute", "limit", "number", True),
    ("compute", "source", "object", True),
]


def tool_messages(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results read from conversations.

    Line n of an assistant's turn is a call with the identifier
    `conversation-turn-n`.  Its length tells its tool (one of them unknown) and
    the shape of its limit.  It takes the result of line n/2 of its turn, the
    first line that of the turn two before.  Line n of a user's turn is the result
    of line n of the turn before.
    """
    lines = conversations.selectExpr("conv_id", "turn", "role", "posexplode(split(text, '\n')) as (n, line)")
    calls = lines.where("role = 'assistant'").selectExpr(
        "conv_id",
        "turn",
        "concat_ws('-', conv_id, turn, n) as call_id",
        "element_at(array('search', 'lookup', 'compute', 'draw'), cast(length(line) % 4 as int) + 1) as name",
        "concat_ws('-', conv_id, if(n = 0, turn - 2, turn), n div 2) as source",
        "line",
    )
    limit = (
        "case when length(line) % 7 = 0 then '' when length(line) % 11 = 0 then '\"limit\": \"all\", '"
        " else concat('\"limit\": ', length(line), ', ') end"
    )
    arguments = (
        "concat('{\"source\": {\"$from\": \"', source, '\"}, ', " + limit + ","
        " '\"query\": ', substr(to_json(struct(line as q)), 6))"
    )
    results = lines.where("role = 'user'").selectExpr(
        "conv_id", "turn", "concat_ws('-', conv_id, turn - 1, n) as call_id", "line as content"
    )
    return calls.selectExpr("conv_id", "turn", "call_id", "name", arguments + " as arguments"), results


def op4_tool_call_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results = tool_messages(common.table(spark, sf_dir, "conversations"))
    schemas = spark.createDataFrame(TOOLS, "tool string, field string, type string, required boolean")
    linked = toolcalls.link(calls, results, schemas)
    return linked.withColumn("problems", F.array_join("problems", "; "))


def op5_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.with_pseudonyms(docs, "text", PII_KEY, count_col="n_replaced")


def learnable(labels: DataFrame) -> DataFrame:
    """The labelled rows that the query may learn from."""
    return labels.where(common.crc_of_id() % 5 != 0)


def op6_bradley_terry_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels")
    ranked = quality.rank(docs, learnable(labels))
    return ranked.select(
        F.col("id").alias("doc_id"),
        (common.crc_of_id("id") % 5 == 0).alias("held_out"),
        "score",
        (F.col("score") >= quality.CUT).cast("int").alias("predicted"),
    )


def op7_gear_chunk_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = chunks.repeated_passages(common.table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "start", "n_bytes", "n_chunks", F.col("first_id").alias("first_doc_id"))


def op8_spaced_seed_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contaminated(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"),
        F.col("item").alias("item_id"),
        F.col("start").alias("start_word"),
        F.col("words").alias("n_words"),
        F.col("equal").alias("n_equal"),
    )


def op9_deletion_variant_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(common.table(spark, sf_dir, "documents"), shingle=4, distance=4, seed=42)
    return found.select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex(F.col("fps")[0]), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def op10_hash_tree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    tree = sharding.even_tree(regions=4, racks=2, shards=2)
    placed = sharding.assign(common.table(spark, sf_dir, "documents"), tree, sharding.with_region(tree, len(tree)))
    return placed.select(
        F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


def op11_overlapped_span_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark")
    drawn = resample.resample(docs, target, percent=10, least_words=20, grams=(1, 1), buckets=10000, seed=2024)
    return drawn.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")


def op12_signature_tree_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sigtree.jaccard_components(common.table(spark, sf_dir, "documents"), shingle=5, similar=80)
    return found.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"))


def op13_net_move_codebooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = sound_vectors(spark, sf_dir).select(
        F.col("vec_id").cast("long").alias("id"), F.col("label").cast("int"), F.expr("transform(e, x -> cast(floor(256 * x) as bigint))").alias("v")
    )
    coded, books = codebooks.compress(vectors, parts=16, entries=64, rounds=2)
    return codebooks.label_errors(coded).select(
        F.col("id").alias("vec_id"),
        F.lower(F.hex("codes")).alias("code"),
        "error",
        "label_error",
        F.lit(books.digest() if books else None).cast("string").alias("codebooks_sha256"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_pivot_distance_top_k,
        op2_hidden_markov_model,
        op3_sum_of_squares_packing,
        op4_tool_call_linking,
        op5_feistel_pseudonyms,
        op6_bradley_terry_quality,
        op7_gear_chunk_repeats,
        op8_spaced_seed_decontamination,
        op9_deletion_variant_simhash,
        op10_hash_tree_shards,
        op11_overlapped_span_resampling,
        op12_signature_tree_join,
        op13_net_move_codebooks,
    )
}
ORACLE = {
    "op1_pivot_distance_top_k": """
        with q as (
            select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)) as v
            from embeddings
            where embedding is not null
              and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        ),
        scored as (
            select a.vec_id as query_id, b.vec_id, list_inner_product(a.v, b.v)::bigint as score
            from q a join q b on a.vec_id <> b.vec_id
            where a.vec_id % 20 = 0
        ),
        ranked as (
            select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from scored
        )
        select query_id, rank, vec_id, score from ranked where rank <= 20
    """,
    "op4_tool_call_linking": """
        with parts as (
            select conv_id, turn, role, string_split(text, chr(10)) as lines from conversations where text is not null
        ),
        lines as (
            select conv_id, turn, role, unnest(lines) as line, unnest(range(len(lines))) as n from parts
        ),
        calls as (
            select conv_id, turn, n, line, conv_id || '-' || turn || '-' || n as call_id,
                ['search', 'lookup', 'compute', 'draw'][length(line) % 4 + 1] as name,
                conv_id || '-' || (case when n = 0 then turn - 2 else turn end) || '-' || (n // 2) as source,
                case when length(line) % 7 = 0 then '' when length(line) % 11 = 0 then '"limit":"all",'
                    else '"limit":' || length(line) || ',' end as "limit",
                case when n = 0 then 0 else length(bin(n)) end::int as level
            from lines where role = 'assistant'
        ),
        answers as (select conv_id, turn, n, line from lines where role = 'user'),
        linked as (
            select c.*, a.turn as result_turn, a.line as result, o.conv_id is null as lost,
                '{' || c."limit" || '"query":' || to_json(c.line) || ',"source":{"$from":"' || c.source || '"}}' as arguments
            from calls c
            left join answers a on a.conv_id = c.conv_id and a.turn = c.turn + 1 and a.n = c.n
            left join calls o on o.conv_id = c.conv_id and o.call_id = c.source
        )
        select conv_id, turn, call_id, name, level,
            row_number() over (partition by conv_id order by turn, level, call_id) - 1 as position,
            arguments,
            array_to_string(list_filter([
                case when name = 'draw' then 'unknown tool'
                    when "limit" = '' and name <> 'lookup' then 'missing limit'
                    when "limit" like '%all%' then 'wrong type of limit' end,
                case when lost then 'unknown reference ' || source end,
                case when result_turn is null then 'no result' end
            ], lambda x: x is not null), '; ') as problems,
            result_turn, result,
            '{"arguments":' || arguments || ',"id":"' || call_id || '","name":"' || name || '","result":'
                || coalesce(to_json(result)::varchar, 'null') || ',"turn":' || turn || '}' as record
        from linked
    """,
    "op11_overlapped_span_resampling": """
        with recursive step(byte, k, c) as (
            select i, 0, i::bigint from range(256) t(i)
            union all
            select byte, k + 1, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end from step where k < 8
        ),
        crc as (select list(c order by byte) as t from step where k = 8),
        texts as (
            select 'doc' as side, doc_id as id, text from documents union all select 'target', item_id, text from benchmark
        ),
        lines as (
            select side, id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as words
            from texts
        ),
        tokens as (select side, id, unnest(words) as w from lines),
        vocabulary as (
            select w, xor(4294967295, list_reduce(
                list_prepend(4294967295::bigint,
                    list_transform(regexp_extract_all(hex(encode(w)), '..'), lambda h: ('0x' || h)::bigint)),
                lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]))) % 10000 as bucket
            from (select distinct w from tokens), crc
        ),
        counts as (
            select bucket, count(*) filter (side = 'doc') as s, count(*) filter (side = 'target') as t
            from tokens join vocabulary using (w) group by bucket
        ),
        totals as (select sum(s)::double as all_s, sum(t)::double as all_t from counts),
        gains as (
            select bucket, floor(1000 * ln((t + 1.0::double) * (all_s + 10000) / ((s + 1.0::double) * (all_t + 10000)))) as gain
            from counts, totals
        ),
        weights as (
            select id, floor(sum(gain) / count(*))::bigint as weight
            from tokens join vocabulary using (w) join gains using (bucket) where side = 'doc' group by id
        ),
        scored as (
            select id as doc_id, len(words)::bigint as n_features, coalesce(weight, 0) as weight,
                coalesce(weight, 0) + floor(-1000 * ln(-ln(
                    (('0x' || substr(sha256('2024:' || id), 1, 8))::bigint + 0.5::double) / 4294967296)))::bigint as score
            from lines left join weights using (id) where side = 'doc'
        ),
        places as (
            select doc_id, row_number() over (order by score desc, doc_id) as place, count(*) over () * 10 // 100 as drawn
            from scored where n_features >= 20
        )
        select doc_id, n_features, weight, score, case when place <= drawn then place end as rank
        from scored left join places using (doc_id)
    """,
    "op12_signature_tree_join": """
        with recursive lines as (
            select doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\\x20\\x09-\\x0D]+') as w
            from documents
        ),
        sets as (
            select doc_id, list_distinct(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
                else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as s
            from lines
        ),
        shingles as (select doc_id, len(s) as n, unnest(s) as x from sets),
        links as materialized (
            select a.doc_id as a, b.doc_id as b
            from shingles a join shingles b on a.x = b.x and a.doc_id < b.doc_id
            group by all having 100 * count(*) >= 80 * (any_value(a.n) + any_value(b.n) - count(*))
        ),
        reach(a, b) as (
            select doc_id, doc_id from sets
            union
            select r.a, l.b from reach r join (select a, b from links union all select b, a from links) l on r.b = l.a
        )
        select doc_id, len(s)::bigint as n_shingles, (select min(b) from reach where a = doc_id) as component_id from sets
    """,
    "op13_net_move_codebooks": """
        with kept as (
            select vec_id, label, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v
            from embeddings
            where embedding is not null
              and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        ),
        parts as (
            select vec_id, p, list_slice(v, p * (len(v) // 16) + 1, (p + 1) * (len(v) // 16)) as x from kept, range(16) t(p)
        ),
        book0 as (
            select p, row_number() over (partition by p order by vec_id) - 1 as e, x as c from parts
            where vec_id in (select vec_id from kept order by vec_id limit 64)
        ),
    """
    + "".join(
        f"""
        at{r} as (
            select vec_id, p, any_value(x) as x, arg_min(e, d * 64 + e) as e, min(d) as d
            from (
                select vec_id, parts.p, x, e,
                    list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint as d
                from parts join book{r} using (p)
            )
            group by vec_id, p
        ),
        means{r} as (
            select p, e, list(m order by i) as c
            from (
                select p, e, i, floor(sum(y)::double / count(*))::bigint as m
                from (select p, e, unnest(x) as y, unnest(range(len(x))) as i from at{r}) group by p, e, i
            )
            group by p, e
        ),
        book{r + 1} as (select p, e, coalesce(m.c, b.c) as c from book{r} b left join means{r} m using (p, e)),
        """
        for r in range(3)
    )
    + """
        codes as (select vec_id, string_agg(format('{:02x}', e), '' order by p) as code, sum(d)::bigint as error from at2 group by vec_id),
        digest as (
            select sha256(string_agg(y::varchar, ',' order by p, e, i)) as codebooks_sha256
            from (select p, e, unnest(c) as y, unnest(range(len(c))) as i from book2)
        )
        select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, codebooks_sha256
        from codes join kept using (vec_id), digest
    """,
}
