"""One query per operator over its whole table, with SQL where SQL can express it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formflow.llm import (
    byte_bpe,
    chat_format,
    decontaminate,
    hilbert_shards,
    html_extract,
    license_scan,
    log_bloom,
    near_dedup,
    orchard,
    periodic_runs,
    quality_rules,
    simhash,
    url_reputation,
)
from formflow.llm.common import ROW, table

QUERIES, ORACLE = {}, {}


def op5_quality_rules(spark, sf_dir) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select(f"{ROW}.doc_id", *quality_rules.MEASURES, "base_failed", "kept")


QUERIES["op5_quality_rules"] = op5_quality_rules

_SPACES = r"[\x20\x09-\x0D]+"
QUALITY_SQL = rf"""
with texts as (
    select row_number() over () as row_no, doc_id, coalesce(text, '') as text from documents
), split_up as (
    select *, list_filter(regexp_split_to_array(text, '{_SPACES}'), lambda x: x <> '') as words,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines,
        len(string_split(text, chr(10))) as all_lines
    from texts
), windows as (
    select row_no, unnest(range(1, len(words) - 1)) as place, words from split_up where len(words) >= 3
), counted as (
    select row_no, place,
        count(*) over (partition by row_no, words[place], words[place + 1], words[place + 2]) as times
    from windows
), covered as (
    select row_no, count(distinct place + step) as n_repeat_words
    from counted, (values (0), (1), (2)) as steps(step)
    where times > 1
    group by row_no
), base as (
    select s.*, len(words)::bigint as n_words, length(array_to_string(words, ''))::bigint as word_chars,
        (length(text) - length(regexp_replace(text, '[#*$%&|<>]+', '', 'g')))::bigint as n_symbols,
        (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
        coalesce(n_repeat_words, 0)::bigint as n_repeat_words
    from split_up s left join covered using (row_no)
), judged as (
    select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
        n_words < 50 or 100 * n_repeat_words > 40 * n_words
        or 10 * n_symbols > n_words
        or word_chars < 2 * n_words or word_chars > 20 * n_words
        or 10 * n_dup_lines > 3 * all_lines
        or 4 * (length(text) - length(replace(text, '!', ''))) > n_words
        or 2 * length(regexp_replace(text, '\P{{Lu}}+', '', 'g')) > word_chars
        or 2 * length(regexp_replace(text, '\P{{L}}+', '', 'g')) < word_chars as rejected
    from base
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not rejected as kept from judged
"""
ORACLE["op5_quality_rules"] = QUALITY_SQL


def op7_minhash_near_dedup(spark, sf_dir) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES["op7_minhash_near_dedup"] = op7_minhash_near_dedup


def op2_benchmark_decontamination(spark, sf_dir) -> DataFrame:
    found = decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return found.select(
        f"{ROW}.doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


QUERIES["op2_benchmark_decontamination"] = op2_benchmark_decontamination

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = r"regexp_extract_all({}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+')"
DECONTAMINATION_SQL = f"""
with items as (
    select item_id, {_ALNUM.format(_LOWER)} as words from benchmark
), sized as (
    select item_id, words, least(13, len(words)) as size from items where len(words) > 0
), windows as (
    select item_id, size, array_to_string(words[place:place + size - 1], ' ') as w
    from (select *, unnest(range(1, len(words) - size + 2)) as place from sized)
), docs as (
    select row_number() over () as row_no, doc_id, {_ALNUM.format(_LOWER)} as words from documents
), places as (
    select row_no, size, place, array_to_string(words[place:place + size - 1], ' ') as w
    from (
        select row_no, words, size, unnest(range(1, len(words) - size + 2)) as place
        from docs, (select distinct size from sized) where len(words) >= size
    )
), found as (
    select row_no, place, p.size, item_id from places p join windows using (size, w)
), hits as (
    select row_no, count(distinct word) as n_hit
    from (select row_no, unnest(range(place, place + size)) as word from found) group by row_no
), named as (
    select row_no, list_sort(list(distinct item_id::varchar)) as ids from found where item_id is not null group by row_no
)
select doc_id, len(words)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(len(ids), 0)::bigint as n_items,
    sha256(coalesce(array_to_string(ids, ','), '')) as items_sha256,
    coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(words) as contaminated
from docs left join hits using (row_no) left join named using (row_no)
"""
ORACLE["op2_benchmark_decontamination"] = DECONTAMINATION_SQL


def encoded_digests(docs: DataFrame) -> DataFrame:
    """The digest columns of op3, from the ids and the bytes decoded from them."""
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    out = byte_bpe.encode(docs, ranks, public_tokenizers.PATTERN, keep=["doc_id"], decoded=True)
    return out.select(
        f"{ROW}.doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op3_byte_bpe(spark, sf_dir) -> DataFrame:
    return encoded_digests(table(spark, sf_dir, "documents"))


QUERIES["op3_byte_bpe"] = op3_byte_bpe


def op10_lm_scoring(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    training = docs.where(~F.coalesce(held_out, F.lit(False)))
    scored = log_bloom.score(docs.withColumn("held_out", F.coalesce(held_out, F.lit(False))), training, keep=["doc_id", "held_out"])
    return scored.select(f"{ROW}.doc_id", f"{ROW}.held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


QUERIES["op10_lm_scoring"] = op10_lm_scoring


SHARDS = 40


def op4_hilbert_sharding(spark, sf_dir) -> DataFrame:
    placed = hilbert_shards.shards(table(spark, sf_dir, "documents"), SHARDS, "rows", keep=["doc_id"])
    return placed.select(
        f"{ROW}.doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "curve"
    )


QUERIES["op4_hilbert_sharding"] = op4_hilbert_sharding


#: Fixed rules of the query.
URL_RULES = (
    url_reputation.Rule("allow", "org/"),
    url_reputation.Rule("block", "example.org/es/"),
    url_reputation.Rule("block", "example.org/en/1"),
    url_reputation.Rule("allow", "com/fr/"),
    url_reputation.Rule("block", "com/de/"),
)


def op1_url_reputation(spark, sf_dir) -> DataFrame:
    """Pages are labelled by the rows of ``labels`` with their number: of bad quality or toxic."""
    outcomes = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), F.expr("quality = 0 or toxic = 1").alias("bad"))
    judged = url_reputation.judge(table(spark, sf_dir, "pages"), outcomes, URL_RULES, keep=["page_id"])
    return judged.select(f"{ROW}.page_id", "host", "path", "rule", "verdict", "bad_rate", "bad_bound")


QUERIES["op1_url_reputation"] = op1_url_reputation

_RULE_CASE = "case " + " ".join(
    f"when (host = '{r.prefix.partition('/')[0]}' or host like '%.{r.prefix.partition('/')[0]}')"
    f" and starts_with(path, '/{r.prefix.partition('/')[2]}') then struct_pack(prefix := '{r.prefix}', verdict := '{r.verdict}')"
    for r in sorted(URL_RULES, key=lambda r: -len(r.prefix))
) + " end"


def _level_sql(name: str, children: str) -> str:
    return f"""
{name}_children as ({children}),
{name}_strength as (
    select case when scale > 0 then 1 / least(greatest(over / scale, 0.001), 0.95) - 1 else 1.0 end as m
    from (select sum((bad - n * prior) ** 2 - n * prior * (1 - prior)) as over, sum(n * (n - 1) * prior * (1 - prior)) as scale
          from {name}_children)
), {name} as (
    select *, sqrt(rate * (1 - rate) / (n + m + 1)) as deviation
    from (select c.*, m, (prior * m + bad) / (n + m) as rate from {name}_children c, {name}_strength)
)"""


URL_SQL = f"""
with parsed as (
    select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) end as rest from pages
), split_up as (
    select page_id, translate(coalesce(regexp_extract(rest, '^([^/?#]*)', 1), ''), '{url_reputation.UPPER}', '{url_reputation.LOWER}') as host,
        coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') as path
    from parsed
), labelled as (
    select doc_id as page_id, max((quality = 0 or toxic = 1)::int) as bad from labels where (quality = 0 or toxic = 1) is not null group by 1
), counted as (
    select host, count(bad)::double as n, coalesce(sum(bad), 0)::double as bad,
        regexp_replace(host, '^.*@|:[0-9]*$|[.]+$|[.]+:[0-9]*$', '', 'g') as name, string_split(name, '.') as parts,
        regexp_matches(name, '^[0-9]+([.][0-9]+){{3}}$|[[]|:') as address
    from split_up left join labelled using (page_id) group by host
), domained as (
    select *, if(address, name, array_to_string(parts[case when array_to_string(parts[-2:], '.') in ({', '.join(f"'{s}'" for s in url_reputation.LONG_SUFFIXES)})
        then -3 else -2 end:], '.')) as domain
    from counted
), hosts as (
    select *, case when contains(domain, '.') and not address then substr(domain, strpos(domain, '.') + 1) else domain end as suffix from domained
), overall as (
    select (coalesce(sum(bad), 0) + 1) / (coalesce(sum(n), 0) + 2) as p from hosts
),
{_level_sql("suffixes", "select suffix, sum(n) as n, sum(bad) as bad, max(p) as prior from hosts, overall group by suffix")},
{_level_sql("domains", "select h.suffix, domain, sum(h.n) as n, sum(h.bad) as bad, max(rate) as prior from hosts h join suffixes s using (suffix) group by h.suffix, domain")},
{_level_sql("rates", "select host, h.n, h.bad, d.rate as prior from hosts h join domains d using (domain)")},
judged as (
    select page_id, host, path, {_RULE_CASE} as m, rate, greatest(0, rate - {url_reputation.DEVIATIONS} * deviation) as bound
    from split_up left join rates using (host)
)
select page_id, host, path, m.prefix as rule, coalesce(m.verdict, case when bound > {url_reputation.LIMIT} then 'block' else 'allow' end) as verdict,
    round(rate, 6) as bad_rate, round(bound, 6) as bad_bound
from judged
"""
ORACLE["op1_url_reputation"] = URL_SQL


def op9_chat_format(spark, sf_dir) -> DataFrame:
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        tokenizer_json = f.read()
    said = "\\### Assistant: </turn> ok"
    fixed = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(fixed)
    return chat_format.read_back(chat_format.format_conversations(rows, tokenizer_json))


QUERIES["op9_chat_format"] = op9_chat_format

ORACLE["op9_chat_format"] = r"""
with turns as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all select -7, 0, 'user', '\### Assistant: </turn> ok'
    union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'
)
select conv_id, count(*) as n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
    coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
    sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), '')) as loss_sha256,
    sum(4 + length(regexp_replace(role, '(\\|###|</turn>|:)', 'x\1', 'g')) + 2
        + length(regexp_replace(text, '(\\|###|</turn>)', 'x\1', 'g')) + 8)::bigint as formatted_chars
from turns group by conv_id
"""


def op8_html_extraction(spark, sf_dir) -> DataFrame:
    found = html_extract.extract(table(spark, sf_dir, "pages"), keep=["page_id", "url"])
    return found.select(f"{ROW}.page_id", f"{ROW}.url", "text", F.length("text").cast("long").alias("n_chars"))


QUERIES["op8_html_extraction"] = op8_html_extraction


def op6_license_scan(spark, sf_dir) -> DataFrame:
    found = license_scan.scan(table(spark, sf_dir, "documents"), keep=["doc_id"])
    named = F.array_sort(F.array_distinct("found"))
    return found.select(
        f"{ROW}.doc_id",
        "paragraphs",
        F.size("found").alias("notices"),
        F.array_join(F.array_remove(named, "unknown"), ",").alias("licenses"),
        F.array_contains("found", "unknown").alias("has_unknown"),
    )


QUERIES["op6_license_scan"] = op6_license_scan


def op11_centroid_clustering(spark, sf_dir) -> DataFrame:
    assigned, centroids = orchard.clusters(table(spark, sf_dir, "embeddings"), keep=["vec_id"])
    out = orchard.with_inertia(assigned, centroids)
    return out.select(f"{ROW}.vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


QUERIES["op11_centroid_clustering"] = op11_centroid_clustering


def _round_sql(k: int) -> str:
    """Round k: vectors to their nearest centroids of the round before; the floor of the means."""
    return f"""
near_{k} as ({_NEAREST.format(centroids=f"centroids_{k - 1}")}),
means_{k} as (
    select number, place, (total - ((total % n) + n) % n) // n as value
    from (
        select number, place, sum(value)::hugeint as total, count(*) as n
        from (select number, unnest(range(1, 65)) as place, unnest(v) as value from near_{k}) group by number, place
    )
), centroids_{k} as (
    select number, coalesce(m.c, o.c) as c
    from centroids_{k - 1} o left join (select number, list(value order by place) as c from means_{k} group by number) m using (number)
)"""


_NEAREST = """
    select row_no, vec_id, v, arg_min(number, struct_pack(d := d, number := number)) as number, min(d) as distance
    from (
        select row_no, vec_id, v, number,
            list_sum(list_transform(list_zip(v, c), lambda x: ((x[1] - x[2]) * (x[1] - x[2]))::hugeint)) as d
        from vectors, {centroids}
    ) group by row_no, vec_id, v"""

ORACLE["op11_centroid_clustering"] = f"""
with vectors as (
    select row_number() over () as row_no, vec_id, list_transform(embedding, lambda x: floor(64 * x::double)::bigint) as v
    from embeddings
    where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), centroids_0 as (
    select number - 1 as number, v::hugeint[] as c
    from (select v, row_number() over (order by sha256('1:' || coalesce(vec_id::varchar, '')), v) as number from vectors) where number <= 16
), {", ".join(_round_sql(k) for k in (1, 2, 3))},
near as ({_NEAREST.format(centroids="centroids_3")}),
named as (select number, sha256(array_to_string(c::varchar[], ',')) as centroid_sha256 from centroids_3)
select vec_id, number::int as cluster, distance::bigint as distance, (sum(distance) over (partition by number))::bigint as cluster_inertia,
    (sum(distance) over ())::bigint as inertia, centroid_sha256
from near join named using (number)
"""


def planted(docs: DataFrame) -> DataFrame:
    """doc_id and text of ``docs``, where one text in ten becomes periodic from some word on."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = "filter(split(coalesce(text, ''), '[\\\\x20\\\\x09-\\\\x0D]+'), x -> x <> '')"
    from_word = "cast(g % size(ws) as int)"
    period = f"cast(1 + (size(ws) - {from_word}) div (3 + g % 8) as int)"
    again = f"transform(ws, (w, i) -> if(i < {from_word}, w, ws[{from_word} + (i - {from_word}) % {period}]))"
    periodic = F.expr(f"array_join(transform(array({words}), ws -> if(size(ws) = 0, ws, {again}))[0], ' ')")
    return docs.select("doc_id", "text", h.alias("h"), F.floor(h / 10).alias("g")).select(
        "doc_id", F.when(F.col("h") % 10 == 0, periodic).otherwise(F.col("text")).alias("text")
    )


def op12_periodic_runs(spark, sf_dir) -> DataFrame:
    found = periodic_runs.periodic_runs(planted(table(spark, sf_dir, "documents")), keep=["doc_id"])
    line = "concat_ws(',', cast(r.start as string), cast(r.length as string), cast(r.period as string))"
    return found.withColumn("best", periodic_runs.longest()).select(
        f"{ROW}.doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.expr(f"array_join(transform(runs, r -> {line} || '\n'), '')"), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES["op12_periodic_runs"] = op12_periodic_runs


def op13_simhash_near_dedup(spark, sf_dir) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return found.select(f"{ROW}.doc_id", "fingerprint", "component_id")


QUERIES["op13_simhash_near_dedup"] = op13_simhash_near_dedup
