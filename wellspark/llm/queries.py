"""The queries of this subpackage over the given tables, and their SQL where there is any."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wellspark.llm import (
    boilerplate,
    brown,
    decontamination,
    isolation,
    order_minhash,
    projection_forest,
    quotations,
    secret_scan,
    sparse_suffixes,
    splitters,
    unigram,
    whitening,
    zone_clusters,
)
from wellspark.llm.rows import stored, table
from wellspark.session import ship_package


def mails(conversations: DataFrame) -> DataFrame:
    """The conversations as mail: every turn but the first quotes in full what it answers, and,
    two levels deep, the first line of what that had answered.

    A turn answers the turn before it, or every fifth turn the one three before. The given
    table has no quotes, so without this there would be nothing to link.
    """
    said = (
        conversations.where("conv_id is not null and turn is not null")
        .groupBy("conv_id", "turn")
        .agg(F.min("role").alias("q_role"), F.min("text").alias("q_text"))
    )
    answered = F.when(F.col("turn") % 5 == 4, F.col("turn") - 3).otherwise(F.col("turn") - 1)
    up = said.select("conv_id", F.col("turn").alias("up"), "q_role", "q_text", answered.alias("up2"))
    up2 = said.select(
        "conv_id",
        F.col("turn").alias("up2"),
        F.concat(F.lit("\n>> "), F.split_part("q_text", F.lit("\n"), F.lit(1))).alias("older"),
    )
    quoted = F.concat(
        F.lit("On turn "),
        F.col("up").cast("string"),
        F.lit(" "),
        F.col("q_role"),
        F.lit(" wrote:\n> "),
        F.replace("q_text", F.lit("\n"), F.lit("\n> ")),
        F.coalesce("older", F.lit("")),
        F.lit("\n"),
    )
    return (
        conversations.withColumn("up", answered)
        .join(up, ["conv_id", "up"], "left")
        .join(up2, ["conv_id", "up2"], "left")
        .select("conv_id", "turn", "role", F.concat(F.coalesce(quoted, F.lit("")), "text").alias("text"))
    )


def op1_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotations.conversations(mails(table(spark, sf_dir, "conversations")))


def op2_site_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Read twice below, so tags are taken out once.
    pages = stored(
        table(spark, sf_dir, "pages").select(
            "page_id",
            boilerplate.host_of(F.col("url")).alias("host"),
            boilerplate.html_lines(F.col("html")).alias("text"),
        ),
        "pages",
    )
    cleaned = boilerplate.without_boilerplate(pages, host="host", counts=("n_lines", "n_dropped"))
    return cleaned.select("page_id", "host", "n_lines", "n_dropped", F.md5("text").alias("text_md5"))


def op3_brown_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brown.scored(table(spark, sf_dir, "documents"))


def op4_isolation_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    judged = isolation.judged(docs, table(spark, sf_dir, "labels"), into="r", keep=["doc_id"])
    return judged.select(
        "doc_id", *[f"r.{c}" for c in isolation.BASE], "r.base_failed", "r.kept", "r.score"
    )


def op5_sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splitters.sharded(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_unigram_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = unigram.encoded(table(spark, sf_dir, "documents"), into="r", keep=["doc_id"])
    return encoded.select(
        "doc_id",
        F.size("r.ids").cast("long").alias("n_pieces"),
        "r.n_byte_pieces",
        "r.log_score",
        F.xxhash64("r.ids").alias("ids_hash"),
        "r.round_trip",
    )


def op7_training_suffix_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontamination.decontaminated(docs, benchmark, into="r", keep=["doc_id"]).select(
        "doc_id", "r.*"
    )


def op8_assignment_lexer(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scanned(table(spark, sf_dir, "documents"), into="r", keep=["doc_id"])
    spans = F.col("r.findings")
    base = secret_scan.of_kinds(spans, *secret_scan.BASE_KINDS)
    counts = {
        kind: F.size(secret_scan.of_kinds(spans, kind)).cast("long").alias(f"n_{kind}")
        for kind in secret_scan.KINDS
    }
    return found.select(
        "doc_id",
        *[counts[kind] for kind in secret_scan.BASE_KINDS],
        F.sha2(secret_scan.listed(base), 256).alias("base_sha256"),
        secret_scan.listed(spans).alias("spans"),
        counts["literal"],
    )


def op9_sparse_suffix_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sparse_suffixes.passages(table(spark, sf_dir, "documents"))


def op10_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = order_minhash.classes(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "class_id", (F.col("doc_id") == F.col("class_id")).alias("kept"), F.hex("node").alias("text_md5")
    )


def op11_cholesky_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings")).select(
        "vec_id",
        "component",
        "n",
        # Null beyond a long; the operator's decimal is exact there too.
        F.col("deviation").try_cast("long").alias("deviation"),
        "whitened",
        "explained",
        "identity_error",
    )


def op12_projection_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return projection_forest.nearest(vectors, vectors.where("vec_id % 100 = 0"))


def op13_zone_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zone_clusters.clustered(table(spark, sf_dir, "embeddings"))


Query = Callable[[SparkSession, str], DataFrame]


def shipped(query: Query) -> Query:
    """The query, after sending the package to executors that may not have it."""

    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)

    return run


QUERIES: dict[str, Query] = {
    f.__name__: shipped(f)
    for f in (
        op1_quotation_linking,
        op2_site_line_frequency,
        op3_brown_classes,
        op4_isolation_forest,
        op5_sampled_splitters,
        op6_unigram_pieces,
        op7_training_suffix_arrays,
        op8_assignment_lexer,
        op9_sparse_suffix_arrays,
        op10_order_minhash,
        op11_cholesky_whitening,
        op12_projection_forest,
        op13_zone_clusters,
    )
}

def _clusters_sql() -> str:
    """k-means in SQL: a table of nearest centroids and one of centroids for each round."""
    nearest = """
        select v.r, arg_min(c.c, (list_sum(list_transform(list_zip(v.x, c.x),
            lambda p: (p[1] - p[2]) * (p[1] - p[2]))), c.c)) as c
        from v, {centroids} as c group by v.r"""
    moved = """
        select before.c, coalesce(after.x, before.x) as x
        from {centroids} as before left join (
            select c, list((s - ((s % n) + n) % n) // n order by i) as x from (
                select a.c, i, sum(v.x[i])::hugeint as s, count(*)::hugeint as n
                from {assigned} as a join v using (r), range(1, {width} + 1) as places(i)
                group by a.c, i
            ) group by c
        ) as after using (c)"""
    steps = []
    for k in range(zone_clusters.ROUNDS + 1):
        steps.append(f"a{k} as materialized ({nearest.format(centroids=f'c{k}')})")
        if k < zone_clusters.ROUNDS:
            made = moved.format(centroids=f"c{k}", assigned=f"a{k}", width=zone_clusters.WIDTH)
            steps.append(f"c{k + 1} as materialized ({made})")
    last = zone_clusters.ROUNDS
    return f"""
        with v as materialized (
            select row_number() over () as r, vec_id,
                list_transform(embedding, lambda c: floor({zone_clusters.SCALE} * c::double)::bigint) as x
            from embeddings
            where len(embedding) = {zone_clusters.WIDTH} and len(list_filter(embedding,
                lambda c: c is not null and abs(c::double) < {zone_clusters.BELOW})) = {zone_clusters.WIDTH}
        ), c0 as materialized (
            select row_number() over (order by h nulls last, x) - 1 as c, x from (
                select sha256('{zone_clusters.SEED}' || vec_id) as h, x from v
            ) order by h nulls last, x limit {zone_clusters.CENTROIDS}
        ), {", ".join(steps)}, found as (
            select v.vec_id, a.c, c.x as middle, list_sum(list_transform(list_zip(v.x, c.x),
                lambda p: (p[1] - p[2]) * (p[1] - p[2])))::bigint as distance
            from a{last} as a join v using (r) join c{last} as c on a.c = c.c
        )
        select vec_id, c::int as cluster, distance,
            (sum(distance) over (partition by c))::bigint as cluster_inertia,
            (sum(distance) over ())::bigint as inertia,
            sha256(array_to_string(middle, ',')) as centroid_sha256
        from found
    """


def _quotations_sql() -> str:
    """Quotes parsed by lines, runs as islands of lines of one level, threads by recursion."""
    answered = "case when {t} % 5 = 4 then {t} - 3 else {t} - 1 end"
    normal = r"trim(regexp_replace(lower({x}), '\s+', ' ', 'g'))"
    units = r"""
        select distinct {keys}, u as unit from (
            select {keys}, unnest(list_concat([text], string_split_regex(text, '\n[ \t\r]*\n'),
                string_split(text, chr(10)))) as raw from {table}
        ), lateral (select {normal} as u) where u <> ''"""
    return rf"""
        with recursive said as (
            select conv_id, turn, min(role) as q_role, min(text) as q_text from conversations
            where conv_id is not null and turn is not null group by conv_id, turn
        ), mails as (
            select distinct c.conv_id, c.turn, c.role, coalesce('On turn ' || u.turn || ' ' || u.q_role
                || ' wrote:' || chr(10) || '> ' || replace(u.q_text, chr(10), chr(10) || '> ')
                || coalesce(chr(10) || '>> ' || split_part(o.q_text, chr(10), 1), '') || chr(10), '')
                || c.text as raw
            from conversations as c
            left join said as u on u.conv_id = c.conv_id and u.turn = {answered.format(t='c.turn')}
            left join said as o on o.conv_id = u.conv_id and o.turn = {answered.format(t='u.turn')}
        ), messages as materialized (
            select row_number() over () as m, * from mails
        ), lines as (
            select m, unnest(string_split(raw, chr(10))) as line,
                generate_subscripts(string_split(raw, chr(10)), 1) as i
            from messages
        ), deep as (
            select *, length(regexp_replace(regexp_extract(line, '{quotations.MARKS}', 0), '[^>]', '', 'g')) as depth
            from lines
        ), levels as (
            select m, i, case when depth = 0 then line
                    else regexp_replace(line, '{quotations.MARKS} ?', '') end as said,
                case when depth = 0 and coalesce(lead(depth) over (partition by m order by i), 0) > 0
                    and regexp_matches(line, '{quotations.HEADER}') then -1 else depth end as level
            from deep
        ), marked as (
            select *, level is distinct from lag(level) over (partition by m order by i) as fresh from levels
        ), islands as (
            select *, sum(fresh::int) over (partition by m order by i) as run from marked
        ), runs as (
            select m, run, any_value(level) as level, string_agg(said, chr(10) order by i) as text
            from islands group by m, run
        ), own as materialized (
            select messages.m, conv_id, turn, role, raw, case when raw is not null then
                regexp_replace(regexp_replace(coalesce(said, ''), '^(?:[ 	]*
)+', ''), '\s+$', '') end as text
            from messages left join (
                select m, string_agg(text, chr(10) order by run) as said from runs where level = 0 group by m
            ) using (m)
        ), passages as materialized (
            select m, conv_id, turn, level, runs.text, row_number() over (partition by m order by run) - 1 as place
            from runs join own using (m) where level > 0 and {normal.format(x='runs.text')} <> ''
        ), firsts as (
            select conv_id, unit, min(turn) as original from ({units.format(
                keys='conv_id, turn', table='own', normal=normal.format(x='raw'))})
            where conv_id is not null and turn is not null group by conv_id, unit
        ), linked as (
            select m, place, level, arg_max(original, (length(unit), -original)) as original
            from ({units.format(keys='m, conv_id, turn, place, level', table='passages', normal=normal.format(x='raw'))})
            join firsts using (conv_id, unit)
            where original < turn group by m, place, level
        ), links as materialized (
            select m, count(*) as n_linked, arg_min(original, (level, place)) as parent_turn from linked group by m
        ), replies as materialized (
            select conv_id, turn, min(parent_turn) as up from links join own using (m) group by conv_id, turn
        ), climbed as (
            select conv_id, turn, up from replies
            union all
            select climbed.conv_id, climbed.turn, replies.up from climbed
            join replies on replies.conv_id = climbed.conv_id and replies.turn = climbed.up
        ), threads as (
            select conv_id, turn, min(up) as thread_turn from climbed group by conv_id, turn
        ), known as (
            select own.*, coalesce(n_quotes, 0) as n_quotes, coalesce(n_linked, 0) as n_linked, parent_turn,
                case when own.conv_id is not null then coalesce(thread_turn, own.turn) end as thread_turn
            from own left join (select m, count(*)::int as n_quotes from passages group by m) using (m)
            left join links using (m)
            left join threads on threads.conv_id = own.conv_id and threads.turn = own.turn
        )
        select conv_id, turn, role, text, n_quotes, n_linked, parent_turn, thread_turn,
            case when conv_id is not null and turn is not null then row_number() over (partition by conv_id
                order by turn is null, thread_turn, turn, role nulls first, text nulls first, raw) - 1 end as position
        from known
    """


ORACLE: dict[str, str] = {
    "op1_quotation_linking": _quotations_sql(),
    "op13_zone_clusters": _clusters_sql(),
    "op2_site_line_frequency": rf"""
        with shown as (
            select row_number() over () as row, page_id,
                nullif(lower(regexp_extract(url, '{boilerplate.HOST}', 1)), '') as host,
                regexp_replace(regexp_replace(regexp_replace(html,
                    '{boilerplate.UNSEEN}', chr(10), 'g'),
                    '{boilerplate.INLINE}', '', 'g'),
                    '<[^>]*>', chr(10), 'g') as text
            from pages
        ), seen as (
            select row, page_id, host, replace(replace(replace(replace(replace(replace(text,
                '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', chr(39)), '&nbsp;', ' '),
                '&amp;', '&') as text
            from shown
        ), lines as (
            select row, host, unnest(string_split(text, chr(10))) as line,
                generate_subscripts(string_split(text, chr(10)), 1) as place
            from seen
        ), bare as (
            select *, trim(line, ' ' || chr(9) || chr(13)) as said from lines
        ), frequent as (
            select host, said from (
                select host, said, count(distinct row) as n from bare
                where said <> '' and host is not null group by host, said
            ) join (
                select host, count(*) as pages from seen where host is not null group by host
            ) using (host)
            where n >= {boilerplate.LEAST_PAGES} and n > {boilerplate.RATIO} * pages
        ), marked as (
            select bare.*, frequent.said is not null as dropped
            from bare left join frequent on bare.host = frequent.host and bare.said = frequent.said
        ), kept as (
            select row, count(*) filter (said <> '') as n_lines, count(*) filter (dropped) as n_dropped,
                md5(coalesce(string_agg(line, chr(10) order by place) filter (not dropped), '')) as text_md5
            from marked group by row
        )
        select page_id, host, coalesce(n_lines, 0) as n_lines, coalesce(n_dropped, 0) as n_dropped,
            text_md5
        from seen left join kept using (row)
    """,
}
