"""DuckDB SQL for the queries that SQL can express in reasonable time on whole tables."""

from __future__ import annotations

from tidemark.llm.quality import BASE, DEFAULT_POLICY, POLICIES, RULES, mask_of


def _share(parent: str, child: str, nodes: str) -> str:
    """What each child gets of its parent's budget: weights are equal."""
    by = f"PARTITION BY {parent}" if parent else ""
    before = f"OVER ({by} ORDER BY lim, {child} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    return f"""
        SELECT *, CASE WHEN lim <= rate THEN CAST(lim AS DOUBLE)
                       ELSE max(CASE WHEN NOT lim <= rate THEN rate END) OVER ({by}) END AS given
        FROM (SELECT *, (budget - coalesce(sum(lim) {before}, 0)) / (count(*) OVER ({by}) - coalesce(count(*) {before}, 0)) AS rate
              FROM ({nodes}))"""


OP5 = f"""
WITH docs AS (
    SELECT doc_id, text, lang, source,
           CASE WHEN regexp_extract(source, '\\d+') <> ''
                THEN 'domain' || CAST(CAST(regexp_extract(source, '\\d+') AS BIGINT) // 5 AS VARCHAR) END AS domain,
           CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS n_tokens
    FROM documents),
named AS (
    SELECT *, coalesce('v' || domain, 'n') AS p0, coalesce('v' || lang, 'n') AS p1, coalesce('v' || source, 'n') AS p2 FROM docs),
leaves AS (SELECT p0, p1, p2, CAST(sum(n_tokens) AS BIGINT) AS tokens FROM named GROUP BY ALL),
l0 AS ({_share("", "p0", "SELECT p0, 2 * sum(tokens) AS lim, (SELECT CAST(sum(tokens) AS DOUBLE) FROM leaves) AS budget FROM leaves GROUP BY p0")}),
l1 AS ({_share("p0", "p1", "SELECT a.p0, p1, lim, given AS budget FROM (SELECT p0, p1, 2 * sum(tokens) AS lim FROM leaves GROUP BY p0, p1) a "
                          "JOIN (SELECT p0, given FROM l0) b ON a.p0 = b.p0")}),
l2 AS ({_share("p0, p1", "p2", "SELECT a.p0, a.p1, p2, tokens, lim, given AS budget FROM (SELECT p0, p1, p2, tokens, 2 * tokens AS lim FROM leaves) a "
                              "JOIN (SELECT p0, p1, given FROM l1) b ON a.p0 = b.p0 AND a.p1 = b.p1")}),
quotas AS (
    SELECT p0, p1, p2, CASE WHEN tokens > 0 THEN CAST(floor(given) AS BIGINT) // tokens ELSE 0 END AS epochs,
           CAST(floor(given) AS BIGINT) AS quota, tokens FROM l2),
placed AS (
    SELECT d.*, epochs, quota - epochs * tokens AS rest,
           sum(n_tokens) OVER (PARTITION BY d.p0, d.p1, d.p2 ORDER BY md5('1:' || CAST(epochs AS VARCHAR) || ':' || coalesce(CAST(doc_id AS VARCHAR), '')), text
                               ROWS UNBOUNDED PRECEDING) AS running
    FROM named d JOIN quotas q ON d.p0 = q.p0 AND d.p1 = q.p1 AND d.p2 = q.p2)
SELECT doc_id, domain, lang, source, n_tokens,
       CAST(epochs + CASE WHEN rest > 0 AND running <= rest THEN 1 ELSE 0 END AS BIGINT) AS copies
FROM placed
"""


WORDS = "SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents"


def _windows(size: int) -> str:
    """Every window of words, as its text (words have no spaces in them)."""
    return f"""SELECT doc_id, s, array_to_string(w[s:s + {size - 1}], ' ') AS k
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - {size - 2})) AS s FROM docs)"""


OP8 = f"""
WITH docs AS ({WORDS}),
later AS (
    SELECT doc_id, s FROM ({_windows(20)}) QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, s) > 1),
gone AS (SELECT DISTINCT doc_id, s + unnest(range(0, 20)) AS p FROM later),
placed AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM docs),
kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text FROM placed ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id) LEFT JOIN (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id) USING (doc_id)
"""

OP9 = f"""
WITH docs AS ({WORDS}),
twice AS (SELECT doc_id, s FROM ({_windows(8)}) QUALIFY count(*) OVER (PARTITION BY doc_id, k) > 1),
repeated AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, s + unnest(range(0, 8)) AS p FROM twice) GROUP BY doc_id),
measured AS (
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
           CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
           CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
           CAST(len(lines) AS BIGINT) AS n_lines, CAST(length(regexp_replace(text, '[^A-Z]', '', 'g')) AS BIGINT) AS n_upper
    FROM (SELECT *, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM docs)
    LEFT JOIN repeated USING (doc_id)),
ruled AS (SELECT *, CAST({" + ".join(f"CASE WHEN {r.fails} THEN {1 << r.bit} ELSE 0 END" for r in RULES)} AS BIGINT) AS fail_mask FROM measured)
SELECT *, fail_mask & {mask_of(BASE)} <> 0 AS base_failed, fail_mask & {mask_of(POLICIES[DEFAULT_POLICY])} = 0 AS kept FROM ruled
"""

OP12 = """
WITH spoken AS (
    SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
pieces AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM spoken),
parts AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM parts GROUP BY lang),
grams AS (
    SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
    FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM parts, (VALUES (1), (2), (3)) AS sizes(k)) GROUP BY ALL),
candidates AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM grams WHERE k > 1 AND f >= 10),
cuts AS (
    SELECT lang, k, phrase, a, w, cut, array_to_string(w[:cut], ' ') AS head, array_to_string(w[cut + 1:], ' ') AS rest
    FROM (SELECT *, unnest(range(1, k)) AS cut FROM candidates)),
scored AS (
    SELECT c.lang, c.phrase, c.a, x.f AS l, y.f AS r, cut,
           (CAST(1000000 AS HUGEINT) * c.a * c.a) // (CAST(x.f AS HUGEINT) * y.f) AS score
    FROM cuts c JOIN grams x ON x.lang = c.lang AND x.phrase = head AND x.k = cut JOIN grams y ON y.lang = c.lang AND y.phrase = rest AND y.k = c.k - cut
    QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, cut) = 1),
absorbed AS (
    SELECT DISTINCT inner_.lang, inner_.phrase
    FROM (SELECT lang, a, array_to_string(w[i:i + 1], ' ') AS part FROM (SELECT *, unnest([1, 2]) AS i FROM candidates WHERE k = 3)) outer_
    JOIN candidates inner_ ON inner_.lang = outer_.lang AND inner_.phrase = part AND inner_.k = 2 AND 100 * outer_.a >= 50 * inner_.a)
SELECT lang, CAST(row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS INTEGER) AS rank, phrase, a, l, r, n,
       CAST(score AS BIGINT) AS score
FROM scored ANTI JOIN absorbed USING (lang, phrase) JOIN totals USING (lang)
QUALIFY rank <= 2000
"""


def _edits() -> str:
    """Backward over the turns: cost, edits and lines of the cheapest way on from each of four states."""
    def on(way: str, cost: str, edit: str, line: str | None = None) -> str:
        lines = f"list_prepend({line}, {way}.t)" if line else f"{way}.t"
        return f"{{c: {way}.c + {cost}, a: '{edit}' || {way}.a, t: {lines}}}"

    def least(*ways: str) -> str:
        return f"list_sort([{', '.join(ways)}])[1]"

    never = "{c: 1000000000, a: '~', t: CAST([] AS VARCHAR[])}"
    extra = "CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END"

    def way(state: str) -> str:
        to, name = ("x", "assistant") if state == "u" else ("u", "user")
        stays = {"e": [("s", "s"), ("u", "u")], "s": [("u", "u")], "u": [("a", "x")], "x": [("u", "u")]}[state]
        keep = "".join(f" WHEN initial = '{i}' THEN {on(b, extra, 'K', 'role || chr(58) || text')}" for i, b in stays)
        free = f"fault IS NULL OR fault = 'truncated'"
        return least(on(state, "4", "D"), f"CASE WHEN {free} THEN CASE{keep} ELSE {never} END ELSE {never} END",
                     f"CASE WHEN {free} THEN {on(to, f'3 + {extra}', 'R', f'{chr(39)}{name}:{chr(39)} || text')} ELSE {never} END")

    user, assistant = "'user:'", "'assistant:'"
    return f"""
WITH RECURSIVE named AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name FROM conversations),
fates AS (
    SELECT *, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(name, ''), lambda ch: CAST(ascii(ch) AS BIGINT))),
                  lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
                  lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295) % 20 AS fate FROM named),
damaged AS (
    SELECT conv_id AS conv, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
           CASE fate WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
           unnest(range(CASE fate WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM fates),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, sha256(CAST(length(role) AS VARCHAR) || ':' || role || text)) AS i,
           rtrim(text, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ') AS said, role[1:1] AS initial FROM damaged),
turns AS (
    SELECT *, CASE WHEN said = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv, role, text ORDER BY i) > 1 THEN 'duplicate'
                   WHEN said[-1:] NOT IN ('.', '!', '?') THEN 'truncated' END AS fault,
           i > 1 AND lag(initial) OVER (PARTITION BY conv ORDER BY i) || initial NOT IN ('su', 'ua', 'au') AS illegal FROM placed),
counted AS (
    SELECT conv, count(*) AS n, CAST(coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS BIGINT) AS gaps,
           count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
           count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (illegal) AS illegal FROM turns GROUP BY conv),
every AS (
    SELECT DISTINCT k.conv_id AS conv, coalesce(n, 0) AS n, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
           coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal
    FROM conversations k LEFT JOIN counted c ON k.conv_id IS NOT DISTINCT FROM c.conv),
ways AS (
    SELECT conv, n + 1 AS i, {{c: 0, a: '', t: CAST([] AS VARCHAR[])}} AS e, {{c: 6, a: 'II', t: [{user}, {assistant}]}} AS s,
           {{c: 3, a: 'I', t: [{assistant}]}} AS u, {{c: 0, a: '', t: CAST([] AS VARCHAR[])}} AS x FROM every
    UNION ALL
    SELECT conv, i, {least('e', on('v', '3', 'I', user))} AS e, {least('s', on('v', '3', 'I', user))} AS s, v AS u,
           {least('x', on('u', '3', 'I', user))} AS x
    FROM (SELECT *, {least('u', on('x', '3', 'I', assistant))} AS v
          FROM (SELECT w.conv, t.i, {way('e')} AS e, {way('s')} AS s, {way('u')} AS u, {way('x')} AS x
                FROM ways w JOIN turns t ON t.conv IS NOT DISTINCT FROM w.conv AND t.i = w.i - 1)))
SELECT q.conv AS conv_id, gaps, blank, duplicate, truncated, illegal, CAST(e.c AS BIGINT) AS cost, e.a AS audit,
       sha256(array_to_string(e.t, chr(10))) AS repaired_sha256
FROM every q JOIN ways w ON w.conv IS NOT DISTINCT FROM q.conv AND w.i = 1
"""


OP13 = _edits()


ABLATION = f"""
WITH ledger AS ({OP9}),
policies (policy, whole) AS (VALUES ('base-1', 3), ('web-1', 127)),
rules (rule, bit) AS (VALUES ('too_few_words', 1), ('repeated_words', 2), ('short_words', 4), ('long_words', 8),
  ('symbols', 16), ('repeated_lines', 32), ('shouting', 64))
SELECT policy, rule, count(*) FILTER (fail_mask & bit <> 0) AS failed, count(*) FILTER (fail_mask & whole = bit) AS only_this,
  count(*) FILTER (fail_mask & whole & ~bit = 0) AS kept_without
FROM policies JOIN rules ON whole & bit <> 0 CROSS JOIN ledger GROUP BY policy, rule
"""


def statements() -> dict[str, str]:
    return {
        "op12_collocations": OP12,
        "op13_conversation_repair": OP13,
        "op5_source_mixing": OP5,
        "op8_substring_dedup": OP8,
        "op9_quality_ledger": OP9,
        "quality_ablation": ABLATION,
    }
