"""Queries whose rows SQL can express as well."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakestrata.llm.filter_audit import audit_orders
from lakestrata.llm.kneser_ney import score_texts
from lakestrata.llm.mixing import poisson_mix
from lakestrata.llm.preference import format_pairs
from lakestrata.llm.ranked_search import search_ranked
from lakestrata.llm.registry import check, table
from lakestrata.llm.secret_scan import ALL_RULES, BASE_RULES, find_secrets, listed

# The hot source is held down; the small ones share the rest evenly.
MIX_WEIGHTS = {"src0": 0.15, "src1": 0.10, "src2": 0.10, "src3": 0.10}
MIX_OTHER = 0.55
MIX_SEED = 17


def mix_sql() -> str:
    named = ", ".join(f"('{k}', {v!r})" for k, v in MIX_WEIGHTS.items())
    unit = "(('0x' || substr(md5(concat_ws('|', '{seed}', '{what}', {key})), 1, 13))::bigint::double + 0.5)"
    u = unit.format(seed=MIX_SEED, what="count", key="doc_id::varchar, '0'")
    order = unit.format(seed=MIX_SEED, what="order", key="doc_id::varchar, copy::varchar")
    return f"""
        WITH named(source, weight) AS (VALUES {named}),
        sized AS (SELECT d.*, n.source AS name, coalesce(n.weight, {MIX_OTHER!r}) AS weight,
                         greatest(coalesce(length(text), 0), 1) AS size
                  FROM documents d LEFT JOIN named n ON d.source = n.source),
        groups AS (SELECT name, any_value(weight) AS weight, sum(size) AS size FROM sized GROUP BY name),
        rates AS (SELECT name, 1.0::double * (SELECT sum(size) FROM groups)::double * weight::double
                         / (SELECT sum(weight::double) FROM groups) / size::double AS rate FROM groups),
        ks AS (SELECT unnest(range(0, 400)) AS k),
        pmf AS (SELECT name, rate, k, exp(k * ln(rate) - rate - lgamma(k + 1)) AS p FROM rates, ks
                WHERE k < rate + 40 + 12 * sqrt(rate)),
        cdf AS (SELECT name, rate, k, sum(p) OVER (PARTITION BY name ORDER BY k) AS c FROM pmf),
        steps AS (SELECT name, any_value(rate) AS rate, list(c ORDER BY k) AS cs FROM cdf GROUP BY name),
        drawn AS (SELECT s.* EXCLUDE (name, weight, size), t.rate,
                         len(list_filter(t.cs, lambda c: c <= {u} / 4503599627370496.0)) AS n
                  FROM sized s JOIN steps t ON s.name IS NOT DISTINCT FROM t.name),
        copies AS (SELECT * EXCLUDE (n), unnest(range(0, n))::integer AS copy FROM drawn)
        SELECT *, floor({order})::bigint AS shuffle_key FROM copies
    """


@check("op6_poisson_mix", mix_sql())
def op6(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return poisson_mix(docs, MIX_WEIGHTS, other=MIX_OTHER, seed=MIX_SEED)


def pair_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Each conversation as chosen; as rejected, with the last turn of the next conversation.

    The text of the last turn of conversation id + 1 takes the place of the own
    one; without such a conversation the last turn is missing.
    """
    last = turns.groupBy("conv_id").agg(F.max("turn").alias("last"))
    marked = turns.join(last, "conv_id")
    closing = marked.where(F.col("turn") == F.col("last")).select(
        (F.col("conv_id") - 1).alias("conv_id"), F.col("text").alias("other_text")
    )
    chosen = turns.withColumnRenamed("conv_id", "pair_id")
    swapped = marked.where(F.col("turn") == F.col("last")).join(closing, "conv_id")
    rejected = (
        marked.where(F.col("turn") < F.col("last"))
        .select("conv_id", "turn", "role", "text")
        .unionByName(swapped.select("conv_id", "turn", "role", F.col("other_text").alias("text")))
        .withColumnRenamed("conv_id", "pair_id")
    )
    return chosen, rejected


PREFERENCE_SQL = """
    WITH marked AS (SELECT *, max(turn) OVER (PARTITION BY conv_id) AS last FROM conversations),
    closing AS (SELECT conv_id - 1 AS conv_id, text AS other FROM marked WHERE turn = last),
    sides AS (
        SELECT conv_id AS pair_id, true AS c, turn, role, text FROM conversations
        UNION ALL SELECT conv_id, false, turn, role, text FROM marked WHERE turn < last
        UNION ALL SELECT m.conv_id, false, turn, role, other FROM marked m JOIN closing USING (conv_id) WHERE turn = last),
    numbered AS (SELECT *, row_number() OVER (PARTITION BY pair_id, c ORDER BY turn, role, text) AS i,
                        '<|' || coalesce(role, '') || '|>' || chr(10) AS head,
                        coalesce(text, '') || '<|end|>' || chr(10) AS tail FROM sides),
    sizes AS (SELECT pair_id, count(*) FILTER (c) AS nc, count(*) FILTER (NOT c) AS nr FROM numbered GROUP BY pair_id),
    differing AS (SELECT a.pair_id, min(a.i) AS i FROM numbered a JOIN numbered b
                  ON a.pair_id = b.pair_id AND a.i = b.i AND a.c AND NOT b.c
                  WHERE a.role IS DISTINCT FROM b.role OR a.text IS DISTINCT FROM b.text GROUP BY a.pair_id),
    prefix AS (SELECT pair_id, nc, nr, coalesce(d.i - 1, least(nc, nr)) AS n FROM sizes LEFT JOIN differing d USING (pair_id)),
    placed AS (SELECT x.*, p.n, p.nc, p.nr,
                      sum(length(head) + length(tail)) FILTER (i > n) OVER (PARTITION BY pair_id, c ORDER BY i) AS stop
               FROM numbered x JOIN prefix p USING (pair_id))
    SELECT pair_id, any_value(n)::bigint AS n_prompt_turns, (any_value(nc) - any_value(n))::bigint AS n_chosen_turns,
           (any_value(nr) - any_value(n))::bigint AS n_rejected_turns,
           coalesce(string_agg(head || tail, '' ORDER BY i) FILTER (c AND i <= n), '') AS prompt,
           coalesce(string_agg(head || tail, '' ORDER BY i) FILTER (c AND i > n), '') AS chosen,
           coalesce(string_agg(head || tail, '' ORDER BY i) FILTER (NOT c AND i > n), '') AS rejected,
           coalesce(string_agg((stop - length(tail))::bigint || '-' || stop::bigint, ',' ORDER BY i)
                    FILTER (c AND i > n AND role = 'assistant'), '') AS chosen_mask,
           coalesce(string_agg((stop - length(tail))::bigint || '-' || stop::bigint, ',' ORDER BY i)
                    FILTER (NOT c AND i > n AND role = 'assistant'), '') AS rejected_mask
    FROM placed GROUP BY pair_id
"""


@check("op4_preference_format", PREFERENCE_SQL)
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return format_pairs(*pair_turns(table(spark, folder, "conversations")))


def secrets_sql() -> str:
    """Offsets from the gaps between matches, as running sums per kind."""
    parts = []
    for order, r in enumerate(ALL_RULES):
        pattern = r.pattern.replace("'", "''")
        parts.append(f"""
            SELECT row, {order} AS o, '{r.kind}' AS kind, unnest(ms) AS m, unnest(gs) AS g, unnest(ps) AS p,
                   unnest(range(0, len(ms))) AS i
            FROM (SELECT row, regexp_extract_all(text, '{pattern}', 0) AS ms, regexp_extract_all(text, '{pattern}', {r.group}) AS ps,
                         list_slice(regexp_split_to_array(text, '{pattern}'), 1, len(regexp_extract_all(text, '{pattern}', 0))) AS gs
                  FROM docs WHERE regexp_matches(text, '{pattern}')) WHERE len(ms) > 0""")
    keep = " OR ".join(f"(o = {o} AND length(p) >= {r.least})" for o, r in enumerate(ALL_RULES))
    n = len(BASE_RULES)
    counts = ", ".join(f"count(*) FILTER (o = {o}) AS n_{r.kind}" for o, r in enumerate(BASE_RULES))
    zeros = ", ".join(f"coalesce(n_{r.kind}, 0)::bigint AS n_{r.kind}" for r in BASE_RULES)
    return f"""
        WITH docs AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
        found AS ({" UNION ALL ".join(parts)}),
        placed AS (SELECT *, (sum(length(g) + length(m)) OVER (PARTITION BY row, o ORDER BY i))::bigint AS stop FROM found),
        kept AS (SELECT row, o, stop, stop - length(m) AS start, kind || ':' || (stop - length(m)) || ':' || stop AS s
                 FROM placed WHERE {keep}),
        joined AS (SELECT row, {counts}, string_agg(s, ',' ORDER BY start, o) AS spans,
                          string_agg(s, ',' ORDER BY start, o) FILTER (o < {n}) AS base FROM kept GROUP BY row)
        SELECT doc_id, {zeros}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
        FROM docs LEFT JOIN joined USING (row)
    """


@check("op9_secret_scan", secrets_sql())
def op9(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = find_secrets(docs).select("doc_id", "secrets")
    base = F.filter("secrets", lambda s: s["order"] < len(BASE_RULES))

    def count(order: int) -> Column:
        return F.size(F.filter("secrets", lambda s: s["order"] == order)).cast("bigint")

    return found.select(
        "doc_id",
        *(count(o).alias(f"n_{r.kind}") for o, r in enumerate(BASE_RULES)),
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("secrets")).alias("spans"),
    )


def audit_conditions() -> dict[str, Column | None]:
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {
        "A": F.size(words) < 100,
        "B": 100 * F.size(F.array_distinct(words)) < 80 * F.size(words),
        "C": 100 * capitals > 10 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
        "E": None,
    }


AUDIT_SQL = r"""
    WITH docs AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
    firsts AS (SELECT t, min(doc_id) AS least FROM docs GROUP BY t),
    flags AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
    split AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words FROM docs JOIN firsts USING (t)),
    judged AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
                      concat(CASE WHEN len(words) < 100 THEN 'A' END,
                             CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 'B' END,
                             CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 10 * length(t) THEN 'C' END,
                             CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' END,
                             CASE WHEN doc_id > least THEN 'E' END) AS failed
               FROM split LEFT JOIN flags USING (doc_id)),
    cells AS (SELECT part, failed, count(*) AS n, count(*) FILTER (good) AS n_good, count(*) FILTER (toxic) AS n_toxic
              FROM judged GROUP BY ALL),
    letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
    orders AS (SELECT a.x || b.x || c.x || d.x || e.x AS o
               FROM letters a, letters b, letters c, letters d, letters e
               WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
    met AS (SELECT *, coalesce((SELECT min(strpos(o, x)) FROM letters WHERE contains(failed, x)), 6) AS gone FROM cells, orders),
    steps AS (SELECT part, o, step, substr(o, step, 1) AS f, sum(n) FILTER (gone > step) AS kept,
                     sum(n) FILTER (gone = step) AS removed,
                     sum(n) FILTER (contains(failed, substr(o, step, 1)) AND gone < step) AS redundant,
                     sum(n) FILTER (failed = substr(o, step, 1)) AS unique_fails,
                     sum(n_good) FILTER (gone = step) AS good_lost, sum(n_toxic) FILTER (gone = step) AS toxic_lost
              FROM met, (SELECT unnest(range(1, 6)) AS step) GROUP BY ALL)
    SELECT part, o AS filter_order, step::integer AS step, coalesce(kept, 0)::bigint AS kept, coalesce(removed, 0)::bigint AS removed,
           coalesce(redundant, 0)::bigint AS redundant, coalesce(unique_fails, 0)::bigint AS unique_fails,
           coalesce(good_lost, 0)::bigint AS good_lost, coalesce(toxic_lost, 0)::bigint AS toxic_lost,
           coalesce(sum(removed) OVER (PARTITION BY part, f), 0)::bigint AS shapley
    FROM steps
"""


@check("op13_filter_audit", AUDIT_SQL)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    """Five filters per language, in all 120 orders."""
    labels = table(spark, folder, "labels")
    flags = labels.select("doc_id", (F.col("quality") == 1).alias("good"), (F.col("toxic") == 1).alias("toxic"))
    return audit_orders(table(spark, folder, "documents"), audit_conditions(), part=F.col("lang"), flags=flags)


SEARCH_SQL = r"""
    WITH folded AS (SELECT doc_id, row_number() OVER () AS d,
                           regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
    sized AS (SELECT d, doc_id, len(terms)::bigint AS n, terms FROM folded WHERE len(terms) > 0),
    total AS (SELECT count(*)::hugeint AS docs, sum(n)::hugeint AS l FROM sized),
    tfs AS (SELECT d, term, count(*)::hugeint AS tf FROM (SELECT d, unnest(terms) AS term FROM sized) GROUP BY ALL),
    weights AS (SELECT term, floor(1000 * ln((2 * docs + 2)::double / (2 * count(*) + 1)::double))::hugeint AS w
                FROM tfs, total GROUP BY term, docs),
    norms AS (SELECT d, doc_id, 25 + (75 * n * docs) // l AS m FROM sized, total),
    asked AS (SELECT item_id, row_number() OVER () AS i,
                     unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                               '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
    queries AS (SELECT i, item_id, term, count(*) AS q FROM asked GROUP BY ALL),
    scores AS (SELECT i, item_id, doc_id, sum(q * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::bigint AS score
               FROM queries JOIN tfs USING (term) JOIN weights USING (term) JOIN norms USING (d) GROUP BY i, item_id, d, doc_id),
    ranked AS (SELECT item_id, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id)::integer AS rank, doc_id, score
               FROM scores WHERE score > 0)
    SELECT * FROM ranked WHERE rank <= 10
"""


@check("op12_ranked_search", SEARCH_SQL)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return search_ranked(table(spark, folder, "benchmark"), table(spark, folder, "documents"), most=10)


KN_SQL = r"""
    WITH bytes AS (SELECT doc_id, row_number() OVER () AS d, text, coalesce(doc_id::varchar, '') AS s FROM documents),
    marked AS (SELECT *, list_reduce(list_prepend(4294967295::bigint, list_transform(range(1, length(s) + 1), lambda i: ascii(s[i])::bigint)),
                          lambda c, x: list_reduce(list_prepend(xor(c, x), range(8)),
                                                   lambda r, k: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END)) AS crc
               FROM bytes),
    docs AS (SELECT doc_id, d, xor(crc, 4294967295) % 5 = 1 AS held_out,
                    list_append(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                   '[^\x20\x09-\x0D]+'), chr(10)) AS words FROM marked),
    tokens AS (SELECT d, held_out, unnest(words) AS w, unnest(list_prepend(chr(13), words[:-2])) AS v FROM docs),
    ones AS (SELECT w, count(*) AS c FROM tokens WHERE NOT held_out GROUP BY w),
    pairs AS (SELECT v, w, count(*) AS c FROM tokens WHERE NOT held_out GROUP BY v, w),
    before AS (SELECT w, count(*) AS c FROM pairs GROUP BY w),
    after AS (SELECT v, sum(c) AS t, count(*) FILTER (c = 1) AS n1, count(*) FILTER (c = 2) AS n2, count(*) FILTER (c > 2) AS n3
              FROM pairs GROUP BY v),
    total AS (SELECT coalesce(sum(c), 0)::bigint AS n, count(*) AS v FROM ones),
    kinds AS (SELECT 1 AS l, c FROM before UNION ALL SELECT 2, c FROM pairs),
    counted AS (SELECT l, sum(c) AS t, count(*) FILTER (c = 1) AS n1, count(*) FILTER (c = 2) AS n2, count(*) FILTER (c = 3) AS n3,
                       count(*) FILTER (c = 4) AS n4, count(*) FILTER (c > 2) AS more FROM kinds GROUP BY l),
    found AS (SELECT *, 1 - 2 * y * n2 / n1 AS e1, 2 - 3 * y * n3 / n2 AS e2, 3 - 4 * y * n4 / n3 AS e3
              FROM (SELECT *, n1::double / (n1 + 2 * n2) AS y FROM counted)),
    less AS (SELECT l, t, n1, n2, more, n1 > 0 AND n2 > 0 AND n3 > 0 AND n4 > 0 AND e1 BETWEEN 0 AND 1 AND e2 BETWEEN 0 AND 2
                    AND e3 BETWEEN 0 AND 3 AS fits, CASE WHEN fits THEN e1 ELSE 0.5 END AS d1, CASE WHEN fits THEN e2 ELSE 1.0 END AS d2,
                    CASE WHEN fits THEN e3 ELSE 1.5 END AS d3 FROM found),
    one AS (SELECT t::double AS t1, d1 * n1 + d2 * n2 + d3 * more AS held1, d1 AS a1, d2 AS a2, d3 AS a3 FROM less WHERE l = 1),
    two AS (SELECT d1, d2, d3 FROM less WHERE l = 2),
    placed AS (SELECT x.d, coalesce(o.c, 0) AS seen, coalesce(b.c, 0) AS b, coalesce(p.c, 0) AS c, a.t, a.n1, a.n2, a.n3
               FROM tokens x LEFT JOIN ones o ON x.w = o.w LEFT JOIN before b ON x.w = b.w LEFT JOIN after a ON x.v = a.v
               LEFT JOIN pairs p ON x.v = p.v AND x.w = p.w),
    scored AS (SELECT d, seen, log10((seen + 0.5::double) / (n + 0.5::double * (v + 1))) AS base, c, t, n1, n2, n3, d1, d2, d3,
                      coalesce((greatest(b - CASE b WHEN 0 THEN 0 WHEN 1 THEN a1 WHEN 2 THEN a2 ELSE a3 END, 0) + held1 / (v + 1)) / t1,
                               1::double / (v + 1)) AS low
               FROM placed CROSS JOIN total LEFT JOIN one ON true LEFT JOIN two ON true),
    final AS (SELECT d, seen, base, CASE WHEN t IS NULL THEN low ELSE
                     (greatest(c - CASE c WHEN 0 THEN 0 WHEN 1 THEN d1 WHEN 2 THEN d2 ELSE d3 END, 0) + (d1 * n1 + d2 * n2 + d3 * n3) * low) / t
                     END AS p FROM scored),
    summed AS (SELECT d, count(*) AS n_tokens, count(*) FILTER (seen > 0) AS n_known, sum(base) AS base_score, sum(log10(p)) AS score
               FROM final GROUP BY d)
    SELECT doc_id, held_out, n_tokens, n_known, n AS train_tokens, base_score, score
    FROM docs JOIN summed USING (d) CROSS JOIN total
"""


@check("op11_kneser_ney", KN_SQL)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    """Bigram model of four fifths of the documents; a document without an id is learned from."""
    docs = table(spark, folder, "documents")
    fifth = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)), F.lit(0))
    scored = score_texts(docs, fifth != 1, order=2)
    return scored.withColumnRenamed("id", "doc_id").select(
        "doc_id", (~F.col("learned")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )
