"""DuckDB SQL for the queries that SQL can express (same columns as the query)."""

from __future__ import annotations

from tessera.llm.common import WORD
from tessera.llm.mixing import MixParams
from tessera.llm.pii import ACCOUNT_LENGTHS, CONTEXT_BONUS, CONTEXT_CHARS, KINDS, MIN_SCORE

WORDS = f"regexp_extract_all(coalesce(text, ''), '{WORD}')"


def _digits(value: str) -> str:
    return f"regexp_replace({value}, '[^0-9]', '', 'g')"


def _luhn(value: str) -> str:
    d = _digits(value)
    return (f"(list_sum(list_transform(range(1, length({d}) + 1), lambda i: CASE WHEN i % 2 = 1 "
            f"THEN substr({d}, length({d}) + 1 - i, 1)::INT WHEN substr({d}, length({d}) + 1 - i, 1)::INT > 4 "
            f"THEN 2 * substr({d}, length({d}) + 1 - i, 1)::INT - 9 "
            f"ELSE 2 * substr({d}, length({d}) + 1 - i, 1)::INT END)) % 10 = 0)")


def _mod97(value: str) -> str:
    s = f"replace({value}, ' ', '')"
    turned = f"(substr({s}, 5) || substr({s}, 1, 4))"
    return (f"(list_reduce(list_transform(string_split({turned}, ''), lambda c: ascii(c)), lambda r, c: CASE WHEN c >= 65 "
            f"THEN (r * 100 + c - 55) % 97 ELSE (r * 10 + c - 48) % 97 END, 0::BIGINT) = 1)")


VALID = {
    "email": "true",
    "ip": "len(list_filter(string_split(v, '.'), lambda p: p::DOUBLE > 255)) = 0",
    "card": f"CASE WHEN length({_digits('v')}) BETWEEN 13 AND 19 THEN {_luhn('v')} ELSE false END",
    "phone": f"length({_digits('v')}) BETWEEN 9 AND 15",
    "iban": f"CASE WHEN v <> '' THEN {_mod97('v')} ELSE false END",
    "ssn": "NOT regexp_matches(v, '^(?:000|666|9)|-00-|-0000$')",
}


def _account(v: str) -> str:
    """A proposed account number up to its country's length, if that ends it."""
    n = f"(CASE substr({v}, 1, 2) {' '.join(f'WHEN {c!r} THEN {n}' for c, n in ACCOUNT_LENGTHS.items())} END)"
    size = f"({n} + CASE WHEN substr({v}, 5, 1) = ' ' THEN ({n} - 1) // 4 ELSE 0 END)"
    return (f"(CASE WHEN length({v}) >= {size} AND substr({v}, {size} + 1, 1) IN ('', ' ') THEN substr({v}, 1, {size}) "
            f"ELSE '' END)")


def pii_sql(relation: str = "documents") -> str:
    """Positions are the lengths of the pieces between the matches added up."""
    hits = "".join(f"""
  {'UNION ALL ' if rank else ''}SELECT rid, {rank} AS rank, '{k.name}' AS kind, {k.confidence} AS confidence,
    '{k.context}' AS context, '{k.apart}' AS apart, {str(k.base).lower()} AS base,
    {_account('hits[i]') if k.name == 'iban' else 'hits[i]'} AS v,
    (coalesce(list_sum(list_transform(gaps[1:i], lambda g: length(g))), 0)
     + coalesce(list_sum(list_transform(hits[1:i - 1], lambda h: length(h))), 0))::BIGINT AS s
  FROM (SELECT rid, hits, gaps, unnest(range(1, len(hits) + 1)) AS i
        FROM (SELECT rid, regexp_extract_all(text, '{k.plain}') AS hits,
                     string_split_regex(text, '{k.plain}') AS gaps FROM d) WHERE len(hits) > 0)"""
                   for rank, k in enumerate(KINDS))
    valid = " ".join(f"WHEN '{k}' THEN {v}" for k, v in VALID.items())
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM {relation}),
hit AS ({hits}),
span AS (
  SELECT rid, rank, kind, base, s, s + length(v) AS e FROM hit JOIN d USING (rid)
  WHERE (CASE kind {valid} END)
    AND (apart = '' OR NOT regexp_matches((CASE WHEN s > 0 THEN substr(text, s, 1) ELSE '' END)
                                          || substr(text, s + length(v) + 1, 1), apart))
    AND (base OR confidence + (CASE WHEN regexp_matches(lower(substr(text, greatest(s - {CONTEXT_CHARS}, 0) + 1,
         least(s, {CONTEXT_CHARS}))), context) THEN {CONTEXT_BONUS} ELSE 0 END) >= {MIN_SCORE})),
doc AS (SELECT rid, count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip,
               count(*) FILTER (kind = 'card') AS n_card, count(*) FILTER (kind = 'phone') AS n_phone,
               string_agg(kind || ':' || s || ':' || e, ',' ORDER BY rank, s) FILTER (base) AS based,
               string_agg(kind || ':' || s || ':' || e, ',' ORDER BY rank, s) AS spans FROM span GROUP BY rid)
SELECT d.doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card,
       coalesce(n_phone, 0) AS n_phone, sha256(coalesce(based, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN doc USING (rid)"""


def mixing_sql(params: MixParams = MixParams(), relation: str = "documents") -> str:
    """The exponent by 60 halvings; blocks, orders and the rest as the operator
    states them (``budget_tokens`` not given: every document is used)."""
    assert params.budget_tokens is None
    seed = params.seed

    def bisect(name: str, test: str, good: bool) -> str:
        return f"""
{name}(i, lo, hi) AS (
  SELECT 0, 0::DOUBLE, 1::DOUBLE
  UNION ALL
  SELECT i + 1, CASE WHEN ok THEN {'mid' if good else 'lo'} ELSE {'lo' if good else 'mid'} END,
         CASE WHEN ok THEN {'hi' if good else 'mid'} ELSE {'mid' if good else 'hi'} END
  FROM (SELECT i, lo, hi, mid, {test} AS ok FROM (SELECT i, lo, hi, (lo + hi) / 2 AS mid FROM {name} WHERE i < 60)))"""
    def entropy(a: str) -> str:
        return f"(SELECT ln(sum(pow(p, {a}))) - {a} * sum(pow(p, {a}) * ln(p)) / sum(pow(p, {a})) FROM share)"

    target = f"({entropy('1.0')} + {params.entropy_gain} * ((SELECT ln(count(*)) FROM share) - {entropy('1.0')}))"
    used = f"pow((SELECT min(p) / max(p) FROM share), mid - 1) <= {params.max_repeats} + 1e-9"
    return f"""
WITH RECURSIVE tok AS (
  SELECT doc_id, source, CASE WHEN source IS NULL THEN '-' ELSE '+' || source END AS skey, len({WORDS}) AS n
  FROM {relation}),
src AS (SELECT skey, sum(n)::BIGINT AS t FROM tok GROUP BY skey),
share AS (SELECT skey, t, t / (SELECT sum(t) FROM src)::DOUBLE AS p FROM src WHERE t > 0),
goal AS (SELECT {target} AS h),
{bisect('ent', entropy('mid') + ' >= (SELECT h FROM goal) - 1e-12', True)},
{bisect('rep', used, False)},
expo AS (SELECT CASE WHEN (SELECT count(*) FROM share) < 2 THEN 1.0 ELSE
  CASE WHEN pow((SELECT min(p) / max(p) FROM share), e - 1) <= {params.max_repeats} + 1e-9 THEN e
       ELSE (SELECT hi FROM rep WHERE i = 60) END END AS a
  FROM (SELECT CASE WHEN {entropy('1.0')} >= (SELECT h FROM goal) - 1e-12 THEN 1.0 ELSE (SELECT lo FROM ent WHERE i = 60) END AS e)),
z AS (SELECT a, sum(pow(p, a)) AS s, sum(t) * sum(pow(p, a)) * pow(max(p), 1 - a) AS budget FROM share, expo GROUP BY a),
plan AS (
  SELECT skey, t, share, weight, budget, n_blocks, CASE WHEN t > 0 THEN budget // t ELSE 1 END AS full_epochs,
         CASE WHEN t > 0 THEN budget % t ELSE 0 END AS rest
  FROM (SELECT skey, t, share, weight, round(weight * (SELECT budget FROM z))::BIGINT AS budget,
               greatest(1, ceil(t / {params.block_tokens}.0))::BIGINT AS n_blocks
        FROM (SELECT skey, t, t / (SELECT sum(t) FROM src)::DOUBLE AS share,
                     CASE WHEN t > 0 THEN pow(t / (SELECT sum(t) FROM src)::DOUBLE, (SELECT a FROM z))
                                          / (SELECT s FROM z) ELSE 0 END AS weight FROM src))),
placed AS (
  SELECT tok.*, share, weight, budget, full_epochs, rest,
         ('0x' || substr(md5('{seed}/' || doc_id), 1, 8))::BIGINT
           % (SELECT greatest(1, ceil(sum(t) / {params.block_tokens}.0))::BIGINT FROM src) % n_blocks AS block,
         md5('{seed}/' || full_epochs || '/' || doc_id) AS o
  FROM tok JOIN plan USING (skey)),
blocks AS (
  SELECT skey, block, bt, rest - coalesce(sum(bt) OVER (PARTITION BY skey ORDER BY turn, block
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS room
  FROM (SELECT skey, block, rest, md5('{seed}/block/' || full_epochs || '/' || block) AS turn, sum(n) AS bt
        FROM placed GROUP BY skey, block, rest, full_epochs)),
drawn AS (
  SELECT doc_id, source, n, share, weight, budget, full_epochs, block, room,
         coalesce(sum(n) OVER (PARTITION BY skey, block ORDER BY o
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used
  FROM placed JOIN blocks USING (skey, block))
SELECT doc_id, source, n AS n_tokens, round(share, 9) AS share, round(weight, 9) AS weight, budget::BIGINT AS budget,
       full_epochs::BIGINT AS full_epochs, block,
       (full_epochs + CASE WHEN room > 0 AND used < room THEN 1 ELSE 0 END)::BIGINT AS copies
FROM drawn"""
