"""Secret scan with corpus-wide ownership frequency, in DataFrame functions only.

Candidates are found in every whole text. The hash of each candidate's value is counted over the
corpus: in how many repositories (here documents) and by how many owners (here sources) it occurs.
A value that at most LIVE_OWNERS owners have is owner-specific and looks live; a value that more
owners have is a copied example. Base kinds are always reported. Further kinds (KEYED) are reported
only where their value looks live.

Positions are code points, the end exclusive. They come from the matches and the text between them:
both lists follow from one regular expression, whose matches are leftmost and do not overlap.

Null and empty texts have no spans. Null owners count as one owner. Repeated rows are scanned each,
but count as one repository if their ids are equal. An empty table gives an empty result. Other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.llm.tables import picked, stored


def _any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


# The base kinds in their order, each with its pattern, the group that holds the value,
# and the least length of that group. A match of [0-9a-f]+ is a whole run of these characters, so the
# matches of 24 and more are just the matches of [0-9a-f]{24,}; the many short runs are passed over.
_KEYWORD = "|".join(map(_any_case, ("password", "passwd", "secret", "token"))) + "|" + _any_case("api") + "_?" + _any_case("key")
BASE = {
    "assign": (f"({_KEYWORD})[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    "access": ("AKIA[A-Z0-9]+", 0, 20),
    "hex": ("[0-9a-f]{24,}", 0, 24),
}
# Public formats of credentials that carry a prefix of their own. A private key goes to
# its end line; without one, over as many lines of its body as follow, up to 60. Each repeat of a group
# takes room on Java's stack, so the repeats are few.
KEYED = "|".join(
    (
        "gh[pousr]_[A-Za-z0-9]{36,}",
        "xox[abprs]-[A-Za-z0-9-]{10,}",
        "AIza[A-Za-z0-9_-]{35}",
        "[sr]k_live_[A-Za-z0-9]{16,}",
        "eyJ[A-Za-z0-9_-]{10,}\\.[A-Za-z0-9_-]{10,}\\.[A-Za-z0-9_-]{10,}",
        "-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----(?:[^-]*(?:-[^-]+){0,8}-----END [A-Z ]{0,20}PRIVATE KEY-----"
        "|(?:(?:\\\\[nr]|[\\x20\\t\\r\\n]){0,4}[A-Za-z0-9+/=]{16,}){0,60})",
    )
)
KINDS = [*BASE, "keyed"]
LIVE_OWNERS = 1
CHUNK = 256

SPAN = "struct<start:int,rank:int,kind:string,end:int,value:string>"


def _literal(pattern: str) -> str:
    return "r'" + pattern.replace("'", "\\x27") + "'"


def matches(text: str, pattern: str) -> str:
    """All matches of a pattern, as SQL text."""
    return f"regexp_extract_all({text}, {_literal(pattern)}, 0)"


def spans_of(kind: str, text: str, found: str) -> str:
    """Spans of one kind, as SQL text over the text and the column of its matches.

    Between two matches lies one piece of the split text; running sums of the lengths give the places.
    A list that grows in ``aggregate`` is copied at each step, so the matches go through in chunks.
    """
    pattern, group, least = BASE.get(kind, (KEYED, 0, 1))
    rank = KINDS.index(kind)
    value = "m.s" if group == 0 else f"regexp_extract(m.s, {_literal(pattern)}, {group})"
    place = "array<struct<start:int,end:int,s:string>>"
    chunks = f"""transform(sequence(0, size({found}) div {CHUNK}), c -> zip_with(slice({found}, c * {CHUNK} + 1, {CHUNK}),
      slice(gaps, c * {CHUNK} + 1, {CHUNK}), (s, gap) -> named_struct('s', s, 'gap', length(gap))))"""
    begin = "coalesce(try_element_at(done, -1).end, try_element_at(try_element_at(parts, -1), -1).end, 0) + x.gap"
    one = f"named_struct('start', {begin}, 'end', {begin} + length(x.s), 's', x.s)"
    chunk = f"aggregate(chunk, CAST(array() AS {place}), (done, x) -> IF(x.s IS NULL, done, concat(done, array({one}))))"
    placed = f"flatten(aggregate({chunks}, CAST(array() AS array<{place}>), (parts, chunk) -> concat(parts, array({chunk}))))"
    span = f"named_struct('start', m.start, 'rank', {rank}, 'kind', '{kind}', 'end', m.end, 'value', {value})"
    # The text is split once: a plain sub-expression would be computed anew for every chunk.
    return f"""IF(size({found}) = 0, CAST(array() AS array<{SPAN}>),
      filter(transform(flatten(transform(array(split({text}, {_literal(pattern)}, -1)), gaps -> {placed})),
        m -> {span}), x -> length(x.value) >= {least}))"""


def written(spans: Column) -> Column:
    """``kind:start:end`` of spans in their order, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def scan(docs: DataFrame, id: str = "doc_id", text: str = "text", owner: str = "source") -> DataFrame:
    """``row, id, owner, base, keyed``: the sorted base spans and the further candidates of each row."""
    rows = picked(docs, id=id, text=text, owner=owner)
    rows = rows.select(F.monotonically_increasing_id().alias("row"), "id", "owner", F.coalesce("text", F.lit("")).alias("text"))
    patterns = {k: p for k, (p, _, _) in BASE.items()} | {"keyed": KEYED}
    found = rows.selectExpr("*", *(f"{matches('text', p)} AS m_{k}" for k, p in patterns.items()))
    spans = found.selectExpr("row", "id", "owner", *(f"{spans_of(k, 'text', f'm_{k}')} AS {k}" for k in KINDS))
    base = F.array_sort(F.concat(*(F.col(k) for k in BASE)))
    return spans.select("row", "id", "owner", base.alias("base"), "keyed")


def ownership(candidates: DataFrame) -> DataFrame:
    """``hash, repositories, owners`` of every different value."""
    places = candidates.select("hash", "id", "owner").distinct()
    by_owner = places.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("n"))
    return by_owner.groupBy("hash").agg(F.sum("n").alias("repositories"), F.count(F.lit(1)).alias("owners"))


def find_secrets(
    docs: DataFrame, id: str = "doc_id", text: str = "text", owner: str = "source", live_owners: int = LIVE_OWNERS
) -> DataFrame:
    """``id, base, spans, live, copied`` of every row: base spans, all spans, and how many values look live or copied.

    A span is ``start, rank, kind, end, hash, repositories, owners``; the secret itself is not given.
    """
    scanned = stored(scan(docs, id, text, owner), "secret-scan")
    one = scanned.select("row", "id", "owner", F.explode(F.concat("base", "keyed")).alias("s"))
    one = one.select("row", "id", "owner", "s.start", "s.rank", "s.kind", "s.end", F.sha2("s.value", 256).alias("hash"))
    counted = ownership(one).withColumn("k", F.hash("hash"))
    known = one.withColumn("k", F.hash("hash")).join(counted, ["hash", "k"])
    live = F.col("owners") <= live_owners
    kept = known.where(live | (F.col("rank") < len(BASE)))
    span = F.struct("start", "rank", "kind", "end", "hash", "repositories", "owners")
    spans = kept.groupBy("row").agg(
        F.array_sort(F.collect_list(span)).alias("spans"),
        F.count_if(live).alias("live"),
        F.count_if(~live).alias("copied"),
    )
    none = F.array().cast(spans.schema["spans"].dataType)
    return scanned.join(spans, "row", "left").select(
        "id",
        "base",
        F.coalesce("spans", none).alias("spans"),
        *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("live", "copied")),
    )


def _oracle() -> str:
    parts = []
    for rank, kind in enumerate(KINDS):
        pattern, group, least = BASE.get(kind, (KEYED, 0, 1))
        sql = "'" + pattern.replace("'", "''") + "'"
        value = "s" if group == 0 else f"regexp_extract(s, {sql}, {group})"
        parts.append(
            f"""SELECT row, doc_id, source, {rank} AS rank, '{kind}' AS kind, s, start, start + length(s) AS "end", {value} AS value
FROM (SELECT row, doc_id, source, m[k] AS s,
    list_sum(list_transform(g[1:k], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:k - 1], lambda x: length(x))), 0) AS start
  FROM (SELECT row, doc_id, source, m, g, unnest(range(1, len(m) + 1)) AS k
    FROM (SELECT row, doc_id, source, regexp_extract_all(t, {sql}) AS m, string_split_regex(t, {sql}) AS g FROM d)))
WHERE length(value) >= {least}"""
        )
    return f"""WITH d AS (SELECT row_number() OVER () AS row, doc_id, source, coalesce(text, '') AS t FROM documents),
one AS ({' UNION ALL '.join(parts)}),
counted AS (SELECT value, count(DISTINCT doc_id) AS repositories, count(DISTINCT source) AS owners FROM one GROUP BY value),
kept AS (SELECT *, kind || ':' || start || ':' || "end" AS w FROM one JOIN counted USING (value)
  WHERE rank < {len(BASE)} OR owners <= {LIVE_OWNERS}),
summed AS (SELECT row, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
  count(*) FILTER (kind = 'hex') AS n_hex, string_agg(w, ',' ORDER BY start, rank) FILTER (rank < {len(BASE)}) AS b,
  string_agg(w, ',' ORDER BY start, rank) AS s, count(*) FILTER (owners <= {LIVE_OWNERS}) AS n_live,
  count(*) FILTER (owners > {LIVE_OWNERS}) AS n_copied FROM kept GROUP BY row)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(b, '')) AS base_sha256, coalesce(s, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_copied, 0) AS n_copied
FROM d LEFT JOIN summed USING (row)"""


ORACLE_SQL = _oracle()
