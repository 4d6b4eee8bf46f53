"""The mixture in ANSI SQL: the same tables, targets, raking steps and draws, written out one after another."""

from __future__ import annotations

from chainlake.llm.mixing import BUDGET, CLIPS, CYCLES, DIMENSIONS, FLATTEN, NONE

TOPIC = """CASE WHEN coalesce(length(text), 0) = 0 THEN 'empty' WHEN text LIKE '%Licensed under%' THEN 'licensed'
 WHEN text LIKE '% | %' THEN 'table' WHEN text LIKE '%@%' THEN 'contact' WHEN length(text) > 5000 THEN 'long'
 WHEN length(text) < 400 THEN 'note' ELSE 'prose' END"""


def mixture_steps(documents: str) -> str:
    """Common table expressions that end in `facts` (rows) and `chances` (cells with their probability)."""
    keys = ", ".join(DIMENSIONS)
    steps = [
        f"""facts AS MATERIALIZED (SELECT *, CASE WHEN bare = '' THEN 0 ELSE length(bare) - length(replace(bare, ' ', '')) + 1 END
 AS tokens FROM (SELECT *, coalesce(source, '{NONE}') AS by_source_key, coalesce(lang, '{NONE}') AS by_lang_key, {TOPIC} AS topic,
 trim(regexp_replace(coalesce(text, ''), '[ \\t-\\r]+', ' ', 'g'), ' ') AS bare FROM {documents}))""",
        f"""cells AS MATERIALIZED (SELECT by_source_key AS source, by_lang_key AS lang, topic, sum(tokens)::DOUBLE AS tokens
 FROM facts GROUP BY ALL)""",
    ]
    for d in DIMENSIONS:
        steps.append(
            f"""goal_{d} AS MATERIALIZED (SELECT {d}, pow(t, {FLATTEN[d]}) / sum(pow(t, {FLATTEN[d]})) OVER () AS target
 FROM (SELECT {d}, sum(tokens) AS t FROM cells GROUP BY {d}) WHERE t > 0)"""
        )
        steps.append(f"f_{d}_0 AS MATERIALIZED (SELECT {d}, 1.0::DOUBLE AS f FROM goal_{d})")
    last = {d: f"f_{d}_0" for d in DIMENSIONS}
    for cycle in range(1, CYCLES + 1):
        for d in DIMENSIONS:
            a, b = (o for o in DIMENSIONS if o != d)
            steps.append(
                f"""f_{d}_{cycle} AS MATERIALIZED (SELECT {d}, target / now AS f FROM (SELECT c.{d}, sum(c.tokens * a.f * b.f) AS now
 FROM cells c JOIN {last[a]} a USING ({a}) JOIN {last[b]} b USING ({b}) GROUP BY c.{d}) JOIN goal_{d} USING ({d}) WHERE now > 0)"""
            )
            last[d] = f"f_{d}_{cycle}"
    factors = " ".join(f"LEFT JOIN {last[d]} {d}_f USING ({d})" for d in DIMENSIONS)
    product = " * ".join(f"{d}_f.f" for d in DIMENSIONS)
    steps.append(f"raked AS MATERIALIZED (SELECT {keys}, tokens, coalesce(tokens * {product}, 0) AS weight FROM cells {factors})")
    steps.append(f"s0 AS MATERIALIZED (SELECT 1.0::DOUBLE AS scale, {BUDGET} * sum(tokens) AS b FROM raked)")
    for i in range(1, CLIPS + 1):
        steps.append(
            f"""s{i} AS MATERIALIZED (SELECT CASE WHEN rest = 0 OR b <= whole THEN scale ELSE (b - whole) / (rest * b) END AS scale, b
 FROM (SELECT sum(CASE WHEN weight * scale * b >= tokens THEN tokens ELSE 0 END) AS whole,
 sum(CASE WHEN weight * scale * b >= tokens THEN 0 ELSE weight END) AS rest, any_value(scale) AS scale, any_value(b) AS b
 FROM raked, s{i - 1}))"""
        )
    steps.append(
        f"""chances AS MATERIALIZED (SELECT {keys}, CASE WHEN tokens > 0 THEN least(1.0, weight * scale * b / tokens) ELSE 0 END
 AS probability FROM raked, s{CLIPS})"""
    )
    return ",\n".join(steps)


DRAW = "('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8))::BIGINT / 4294967296.0"


def mixture_sql(documents: str) -> str:
    return f"""WITH {mixture_steps(documents)}
SELECT doc_id, by_source_key AS source, by_lang_key AS lang, f.topic, tokens AS n_tokens, round(probability, 6) AS probability,
 {DRAW} < probability AS drawn
FROM facts f JOIN chances c ON f.by_source_key = c.source AND f.by_lang_key = c.lang AND f.topic = c.topic"""
