"""The registered queries of the training-data operators: one thin query for each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chalkline.llm import bpe, chat, embeddings, hosts, lines, minhash, mixing, nearest, negatives, periods, quality, repeats, secrets

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _reach(links: str) -> str:
    """CTEs that name the least node reachable over ``links`` (a, b), both ways round, as ``least`` (a, component)."""
    return f"""
    reach(a, b) as (select a, b from ({links}) l union select r.a, l.b from reach r join ({links}) l on r.b = l.a),
    least as (select a, least(a, min(b)) as component from reach group by a)"""


@query(
    "op3_minhash",
    f"""
    with recursive w as (
        select doc_id, list_filter(string_split_regex(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'
        ), lambda x: x <> '') as words from documents
    ),
    s as materialized (
        select distinct doc_id, unnest(list_transform(
            range(1, greatest(len(words) - 4, case when len(words) > 0 then 1 else 0 end) + 1),
            lambda i: array_to_string(words[i : i + 4], ' ')
        )) as shingle from w
    ),
    n as materialized (select doc_id, count(*) as size from s group by doc_id),
    common as materialized (
        select x.doc_id as a, y.doc_id as b, count(*) as shared from s x join s y using (shingle)
        where x.doc_id <> y.doc_id group by all
    ),
    links as materialized (
        select a, b from common join n p on p.doc_id = a join n q on q.doc_id = b
        where 100 * shared >= 85 * (p.size + q.size - shared)
    ),
    {_reach("select a, b from links")}
    select doc_id, coalesce(size, 0) as n_shingles, coalesce(component, doc_id) as component_id,
        coalesce(component, doc_id) = doc_id as kept
    from documents left join n using (doc_id) left join least on a = doc_id
    """,
)
def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), percent=85).drop("row")


@query("op4_quality")
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def vocabulary_path() -> str:
    """Where the box keeps its vocabulary; the operators take any path."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query("op8_bpe")
def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf_dir, "documents"), vocabulary_path(), decode=True).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


@query("op10_lines")
def op10_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.fuzzy_lines(table(spark, sf_dir, "documents")).drop("row")


def example_conversation(spark: SparkSession) -> DataFrame:
    """Conversation -7: both turns say what looks like a template's marks."""
    return spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )


# The marks and control strings of chat.py, escaped as there.
_ESCAPE = r"""regexp_replace({0}, '([<\[])(\\*)(\|im_start\|>|\|im_end\|>|\|endoftext\|>|s>|/s>|INST\]|/INST\]|<SYS>>|</SYS>>)', '\1\2\\\3', 'g')"""


@query(
    "op6_chat",
    f"""
    with turns as (
        select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
        union all
        values (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
    )
    select
        conv_id,
        count(*) as n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
        sum(case when role = 'assistant' then length(text) else 0 end)::bigint as loss_chars,
        sha256(string_agg(case when role = 'assistant' then text else '' end, '' order by turn nulls first, role, text)) as loss_sha256,
        sum(length(role) + length({_ESCAPE.format("text")}) + 12 + 1 + 10 + 1)::bigint as formatted_chars
    from turns
    group by conv_id
    """,
)
def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    made = chat.formatted(chat.canonical(rows.unionByName(example_conversation(spark))))
    read = made.select("conv_id", "formatted", chat.read_back(F.col("formatted")).alias("turns"), chat.loss_text("segments").alias("loss"))
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


@query("op7_secrets")
def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    number = [secrets.number_of("base", k).cast("long").alias(f"n_{name}") for k, name in enumerate(secrets.KINDS[:3])]
    return found.select(
        "doc_id",
        *number,
        F.sha2(secrets.listed(F.col("base")), 256).alias("base_sha256"),
        secrets.listed(F.concat("base", "linked")).alias("spans"),
    )


# Fixed values: (host, path, verdict).
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def _level(name: str, groups: str, prior: str) -> str:
    """CTEs of one level of the shrinkage: ``groups`` has key, good, total and ``prior``."""
    return f"""
    {name}_in as ({groups}),
    {name}_fit as (
        select sum(total) as n, count(*) filter (where total > 0) as k, sum(total * {prior} * (1 - {prior})) as v,
            sum(total * power(good / nullif(total, 0) - {prior}, 2)) as between_groups
        from {name}_in
    ),
    {name}_rho as (select *, ((between_groups * n / nullif(v, 0)) - k) / nullif(n - k, 0) as rho from {name}_fit),
    {name} as (
        select i.*, good + s * {prior} as alpha, total - good + s * (1 - {prior}) as beta
        from {name}_in i, (
            select case when v > 0 and n > k
                then round(least(1000.0, greatest(1.0, case when rho > 0 then 1 / rho - 1 else 1000.0 end)), 6) else 1000.0 end as s
            from {name}_rho
        ) f
    )"""


_BARE = "regexp_replace(host, ':[0-9]*$', '')"
_ADDRESS = rf"regexp_full_match({_BARE}, '[0-9]{{1,3}}(\.[0-9]{{1,3}}){{3}}|\[(?s:.*)\]')"
_LABELS = f"string_split({_BARE}, '.')"
# One label more where the last two are a public suffix.
_SUFFIX_LABELS = f"case when array_to_string({_LABELS}[-2:], '.') in {hosts.SUFFIXES} then 2 else 1 end"
_RULE_CASES = " ".join(
    f"""when (host = '{h}' or ends_with(host, '.{h}')) and starts_with(path, '{p}') then '{h}{p}|{v}'"""
    for h, p, v in sorted(RULES, key=lambda r: -len(r[0] + r[1]))
)


@query(
    "op9_hosts",
    f"""
    with parts as (
        select page_id,
            translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
            regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) as path
        from pages
    ),
    known as (select doc_id, min(quality) as good from labels where quality in (0, 1) group by doc_id),
    hosts as (
        select host, coalesce(sum(good), 0)::double as good, count(good)::double as total,
            case when {_ADDRESS} then {_BARE} else array_to_string({_LABELS}[-1 - ({_SUFFIX_LABELS}):], '.') end as domain,
            case when {_ADDRESS} then '{hosts.ADDRESS}' else array_to_string({_LABELS}[-({_SUFFIX_LABELS}):], '.') end as suffix
        from parts left join known on doc_id = page_id group by host
    ),
    {_level("s", "select suffix, sum(good) as good, sum(total) as total, (select sum(good) / sum(total) from hosts) as p from hosts group by suffix", "p")},
    {_level("d", "select h.domain, h.suffix, sum(h.good) as good, sum(h.total) as total, any_value(s.alpha / (s.alpha + s.beta)) as p from hosts h join s using (suffix) group by h.domain, h.suffix", "p")},
    {_level("h", "select host, hosts.good, hosts.total, d.alpha / (d.alpha + d.beta) as p from hosts join d using (domain, suffix)", "p")},
    judged as (
        select host, alpha / (alpha + beta) + 1.645 * sqrt(alpha * beta / (power(alpha + beta, 2) * (alpha + beta + 1))) < 0.5 as bad
        from h
    ),
    ruled as (select *, case {_RULE_CASES} end as found from parts)
    select page_id, host, path, string_split(found, '|')[1] as rule,
        coalesce(string_split(found, '|')[2], case when bad then 'block' else 'allow' end) as verdict
    from ruled left join judged using (host)
    """,
)
def op9_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hosts.judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"), RULES)


# Target weights of the mix: a leaf's weight is the product of its domain's and its language's.
LONG_TEXT = 2000
DOMAIN_WEIGHTS = {"long": 3, "short": 1}
LANGUAGE_WEIGHTS = {"en": 4, "de": 2, "fr": 2}
PERMILLE, EPOCHS, SEED = 500, 2, 7


def with_domain(docs: DataFrame) -> DataFrame:
    """Long and short texts are the domains."""
    return docs.withColumn("domain", F.when(F.length("text") >= LONG_TEXT, "long").otherwise("short"))


def leaf_weights(docs: DataFrame) -> DataFrame:
    """A row for each domain, language and source that occurs."""

    def weight(column: str, table: dict[str, int]):
        out = F.lit(1)
        for name, value in table.items():
            out = F.when(F.col(column) == name, value).otherwise(out)
        return out

    leaves = docs.select("domain", "lang", "source").distinct()
    return leaves.withColumn("weight", (weight("domain", DOMAIN_WEIGHTS) * weight("lang", LANGUAGE_WEIGHTS)).cast("long"))


def mixed(docs: DataFrame) -> DataFrame:
    docs = with_domain(docs)
    return mixing.mix(docs, leaf_weights(docs.select("domain", "lang", "source")), PERMILLE, EPOCHS, SEED)


def mixing_sql(documents: str) -> str:
    """The mix of a table with doc_id, text, lang and source, as SQL."""
    levels, steps = ("domain", "lang", "source"), []
    leaf = "leaves"
    for depth, level in enumerate(levels):
        above, key = ", ".join(levels[:depth]), ", ".join(levels[: depth + 1])
        family = f"partition by {above}" if above else ""
        steps.append(f"""
        nodes{depth} as (
            select {key}, sum(weight) as w, sum({EPOCHS} * tokens) as cap, min(budget) as given from {leaf} group by {key}
        ),
        ordered{depth} as (
            select *,
                row_number() over o as place,
                given - coalesce(sum(cap) over (o rows between unbounded preceding and 1 preceding), 0) as remaining,
                sum(w) over (o rows between current row and unbounded following) as rest
            from nodes{depth} window o as ({family} order by cap / w, cap, {level})
        ),
        opened{depth} as (
            select *, arg_min(remaining, place) filter (cap * rest > remaining * w) over (a) as open_left,
                arg_min(rest, place) filter (cap * rest > remaining * w) over (a) as open_rest,
                min(place) filter (cap * rest > remaining * w) over (a) as open_place
            from ordered{depth} window a as ({family})
        ),
        level{depth} as (
            select l.* replace (
                (case when open_place is null or place < open_place then cap else (w * open_left) // open_rest end)::bigint as budget
            )
            from {leaf} l join opened{depth} using ({key})
        )""")
        leaf = f"level{depth}"
    domain_weight = " ".join(f"when domain = '{k}' then {v}" for k, v in DOMAIN_WEIGHTS.items())
    language_weight = " ".join(f"when lang = '{k}' then {v}" for k, v in LANGUAGE_WEIGHTS.items())
    place = f"cast('0x' || substr(md5('{SEED}:' || epoch || ':' || doc_id), 1, 15) as bigint)"
    return f"""
    with d as (
        select doc_id, coalesce(lang, '') as lang, coalesce(source, '') as source,
            case when length(text) >= {LONG_TEXT} then 'long' else 'short' end as domain,
            len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::bigint as n_words
        from {documents}
    ),
    leaves as (
        select domain, lang, source, sum(n_words)::bigint as tokens,
            (case {domain_weight} end) * (case {language_weight} else 1 end) as weight,
            (select (sum(n_words) * {PERMILLE}) // 1000 from d)::bigint as budget
        from d group by domain, lang, source
    ),
    {",".join(steps)},
    placed as (
        select d.*, epoch, budget, tokens, {place} as place
        from d join {leaf} using (domain, lang, source), range(1, {EPOCHS} + 1) as e(epoch)
        where tokens > 0
    ),
    summed as (
        select *, sum(n_words) over (partition by domain, lang, source order by epoch, place) as until from placed
    )
    select doc_id, domain, lang, source, epoch, n_words from summed where until <= budget
    """


@query("op2_mixing", mixing_sql("documents"))
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(table(spark, sf_dir, "documents")).select("doc_id", "domain", "lang", "source", "epoch", "n_words")


@query(
    "op1_embeddings",
    f"""
    with recursive v as (
        select vec_id, embedding::double[] as e from embeddings
        where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
            and len(list_filter(embedding, lambda x: x <> 0)) > 0
    ),
    links as materialized (
        select x.vec_id as a, y.vec_id as b from v x join v y
        on x.vec_id <> y.vec_id and len(x.e) = len(y.e) and list_cosine_similarity(x.e, y.e) >= 0.95
    ),
    {_reach("select a, b from links")}
    select vec_id, coalesce(n, 0) as n_links, coalesce(component, vec_id) as component_id,
        coalesce(component, vec_id) = vec_id as kept
    from embeddings left join (select a, count(*) as n from links group by a) using_a on using_a.a = vec_id
        left join least on least.a = vec_id
    """,
)
def op1_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(table(spark, sf_dir, "embeddings"))


@query(
    "op5_nearest",
    """
    with v as (
        select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)) as e from embeddings
        where vec_id is not null and embedding is not null
            and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    ),
    scored as (
        select q.vec_id as query_id, d.vec_id as vec_id, list_inner_product(q.e, d.e)::bigint as score
        from v q join v d on q.vec_id % 100 = 0 and q.vec_id <> d.vec_id and len(q.e) = len(d.e)
    ),
    ranked as (select *, row_number() over (partition by query_id order by score desc, vec_id)::integer as rank from scored)
    select query_id, rank, vec_id, score from ranked where rank <= 10
    """,
)
def op5_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.top_by_inner_product(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


# crc32 of the decimal digits of a bigint, from a table made by its rule.
_CRC_TABLE = """
    select list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
        lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as crc"""
_CRC = """xor(list_reduce(
    list_prepend(4294967295::bigint, list_transform(string_split(doc_id::varchar, ''), lambda x: ascii(x)::bigint)),
    lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])), 4294967295)"""


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """doc_id and text, where one document in ten repeats a stretch of its own words to its end."""
    h = F.crc32(F.col("doc_id").cast("string"))
    split = docs.select("doc_id", "text", h.alias("h"), F.floor(h / 10).alias("g")).withColumn(
        "words", F.when(F.col("h") % 10 == 0, F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != ""))
    )
    sized = split.withColumn("n", F.size("words")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    sized = sized.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    rest = F.col("n") - F.col("a")
    again = F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), F.ceil(rest / F.col("p")).cast("int")))
    tiled = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), F.slice(again, F.lit(1), rest)), " ")
    return sized.select("doc_id", F.when(F.col("n") > 0, tiled).otherwise(F.col("text")).alias("text"))


@query(
    "op12_periods",
    f"""
    with split as (
        select doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w from documents
    ),
    named as (select doc_id, w, len(w) as n, {_CRC} as h from split, ({_CRC_TABLE})),
    tiled as (
        select doc_id, n, case when h % 10 = 0 and n > 0
            then list_transform(range(n), lambda i: w[case when i < a then i else a + (i - a) % (1 + (n - a) // (3 + (h // 10) % 8)) end + 1])
            else w end as w
        from (select *, (h // 10) % greatest(n, 1) as a from named)
    ),
    texts as materialized (select row_number() over () as t, * from tiled),
    grams as materialized (
        select t, n, unnest(range(n - 5)) as i, unnest(list_transform(range(n - 5), lambda i: array_to_string(w[i + 1 : i + 6], ' '))) as gram
        from texts where n >= 6
    ),
    agree as (select x.t, x.i, y.i - x.i as p from grams x join grams y on x.t = y.t and x.gram = y.gram and y.i > x.i and 2 * (y.i - x.i) <= x.n),
    stretches as (
        select t, p, min(i) as start, count(*) + 5 + p as length
        from (select *, i - row_number() over (partition by t, p order by i) as island from agree) group by t, p, island
    ),
    runs as materialized (
        select t, start, length, min(p) as period from stretches where length >= greatest(12, 2 * p) group by t, start, length
    ),
    told as (
        select t, count(*) as n_runs, arg_min({{'s': start, 'l': length, 'p': period}}, {{'a': -length, 'b': start, 'c': period}}) as best,
            string_agg(start || ',' || length || ',' || period || chr(10), '' order by start, period) as listing
        from runs group by t
    ),
    gone as (select distinct t, unnest(range(start + period, start + length)) as i from runs),
    kept as (
        select t, string_agg(word, ' ' order by i) as collapsed
        from (select t, unnest(range(n)) as i, unnest(w) as word from texts) anti join gone using (t, i) group by t
    )
    select doc_id, coalesce(n_runs, 0) as n_runs, best.s as start, best.l as length, best.p as period,
        (1000 * best.l) // best.p as exponent_milli, sha256(coalesce(listing, '')) as runs_sha256, sha256(coalesce(collapsed, '')) as collapsed_sha256
    from texts left join told using (t) left join kept using (t)
    """,
)
def op12_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periods.runs(with_planted_periods(table(spark, sf_dir, "documents")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    told = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    return found.withColumn("best", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.floor(1000 * F.col("best.length") / -F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(told, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query(
    "op11_repeats",
    """
    with texts as materialized (
        select row_number() over () as t, doc_id, hex(encode(coalesce(text, ''))) as h, octet_length(encode(coalesce(text, ''))) as n_bytes
        from documents
    ),
    strings as materialized (
        select t, unnest(range(n_bytes - 199)) as i, unnest(list_transform(range(n_bytes - 199), lambda i: md5_number(substr(h, 2 * i + 1, 400)))) as string
        from texts where n_bytes >= 200
    ),
    again as (select string from strings group by string having count(*) > 1),
    starts as materialized (select t, i from strings where string in (select string from again)),
    reached as (select t, i, max(i) over (partition by t order by i rows between unbounded preceding and 1 preceding) + 200 as before from starts),
    spans as materialized (
        select t, min(i) as low, max(i) + 200 as high
        from (select t, i, sum(case when before is null or before < i then 1 else 0 end) over (partition by t order by i) as span from reached)
        group by t, span
    ),
    removed as (select t, sum(high - low)::bigint as n_removed, count(*) as n_spans from spans group by t),
    pieces as (
        select t, low, lag(high, 1, 0) over (partition by t order by low) as from_byte, low as to_byte from spans
        union all
        select t, n_bytes, coalesce((select max(high) from spans s where s.t = texts.t), 0), n_bytes from texts
    ),
    kept as (
        select t, string_agg(substr(h, 2 * from_byte + 1, 2 * (to_byte - from_byte)), '' order by low, from_byte) as kept
        from pieces join texts using (t) group by t
    )
    select doc_id, n_bytes, coalesce(n_removed, 0) as n_removed, coalesce(n_spans, 0) as n_spans, sha256(unhex(kept)) as kept_sha256
    from texts left join removed using (t) left join kept using (t)
    """,
)
def op11_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.without_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_bytes",
        F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"]).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query(
    "op13_negatives",
    """
    with v as materialized (
        select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
            list_transform(embedding, lambda x: floor(256 * x::double)) as e
        from embeddings
        where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    ),
    scored as materialized (
        select a.vec_id as anchor_id, b.vec_id as other_id, a.label = b.label as same, list_inner_product(a.e, b.e)::bigint as score
        from v a join v b on a.vec_id % 50 = 0 and a.vec_id <> b.vec_id and len(a.e) = len(b.e)
    ),
    positives as (
        select anchor_id, other_id as positive_id, score as positive_score from scored where same
        qualify row_number() over (partition by anchor_id order by score desc, other_id) <= 5
    )
    select anchor_id, positive_id, other_id as negative_id, positive_score, score as negative_score,
        row_number() over (partition by anchor_id, positive_id order by score desc, other_id)::integer as rank
    from positives join scored using (anchor_id)
    where not same and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score
    qualify rank <= 3
    """,
)
def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").withColumn("label", shifted)
    return negatives.hard_negatives(rows, F.col("vec_id") % 50 == 0)
