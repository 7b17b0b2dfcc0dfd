"""DuckDB texts for every registered query (the correctness oracle).

Written independently of the Spark code: plain SQL over the pre-registered
views.  The tree is unrolled level by level as CTEs generated from one
template (at most ``len(ATTRIBUTES) + 1`` levels), and prediction walks the
tree with one left join per level.
"""

from __future__ import annotations

from canopy.operators.prepare import ATTRIBUTES

A = list(ATTRIBUTES)

L_BASE = """
SELECT concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR)) AS key,
       l_orderkey, l_linenumber,
       r_name AS marketplace, l_linestatus AS verified_purchase, o_orderstatus AS vine,
       c_mktsegment AS product_category, CAST(l_extendedprice AS DOUBLE) AS body_len,
       coalesce(l_tax / nullif(l_discount, 0) > 0.5, false) AS is_vote_helpful
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
     JOIN customer ON o_custkey = c_custkey
     JOIN nation ON c_nationkey = n_nationkey
     JOIN region ON n_regionkey = r_regionkey
"""

D_BASE = """
SELECT CAST(d.doc_id AS VARCHAR) AS key, d.doc_id,
       coalesce(lang, 'false') AS marketplace,
       coalesce(CAST(quality AS VARCHAR), 'false') AS verified_purchase,
       coalesce(CAST(toxic AS VARCHAR), 'false') AS vine,
       coalesce(source, 'false') AS product_category,
       CAST(coalesce(length(text), 0) AS DOUBLE) AS body_len,
       coalesce(length(regexp_replace(text, '[^aeiou]', '', 'g')) / nullif(n_chars, 0) > 0.3, false)
           AS is_vote_helpful
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
"""


def bucket(key: str) -> str:
    return f"(('0x' || substr(md5({key}), 1, 8))::BIGINT % 100)"


def bin_expr(v: str, cut: str) -> str:
    return (
        f"CASE WHEN {v} <= {cut}.q1 THEN '(0,Q1]' WHEN {v} <= {cut}.q2 THEN '(Q1,Q2]' "
        f"WHEN {v} <= {cut}.q3 THEN '(Q2,Q3]' ELSE 'Q3' END"
    )


def sides(base: str) -> str:
    """CTEs ``base, tr, te, cut_tr, cut_te, train, test``."""
    cuts = "quantile_disc(body_len, 0.25) AS q1, quantile_disc(body_len, 0.5) AS q2, quantile_disc(body_len, 0.75) AS q3"
    return f"""base AS ({base}),
tr AS (SELECT * FROM base WHERE {bucket('key')} < 70),
te AS (SELECT * FROM base WHERE {bucket('key')} >= 70),
cut_tr AS (SELECT {cuts} FROM tr),
cut_te AS (SELECT {cuts} FROM te),
train AS (SELECT tr.*, {bin_expr('tr.body_len', 'cut_tr')} AS review_body FROM tr, cut_tr),
test AS (SELECT te.*, {bin_expr('te.body_len', 'cut_te')} AS review_body FROM te, cut_te)"""


def H(p: str, n: str) -> str:
    P, N = f"CAST({p} AS DOUBLE)", f"CAST({n} AS DOUBLE)"
    T = f"({P} + {N})"
    return (
        f"(CASE WHEN {T} > 0 THEN (CASE WHEN {P} > 0 THEN -({P} / {T}) * log2({P} / {T}) ELSE 0 END)"
        f" + (CASE WHEN {N} > 0 THEN -({N} / {T}) * log2({N} / {T}) ELSE 0 END) ELSE 0 END)"
    )


def r9(x: str) -> str:
    return f"(round({x}, 9) + 0.0)"


def cells_cte(src: str, name: str = "cells") -> str:
    cols = ", ".join(A)
    return (
        f"{name} AS (SELECT {cols}, CAST(count_if(is_vote_helpful) AS BIGINT) AS pos, "
        f"CAST(count_if(NOT is_vote_helpful) AS BIGINT) AS neg FROM {src} GROUP BY {cols})"
    )


def long_union(rel: str, ids: list[str], attrs: list[str]) -> str:
    id_cols = "".join(f"{c}, " for c in ids)
    return " UNION ALL ".join(f"SELECT {id_cols}'{a}' AS attr, {a} AS value, pos, neg FROM {rel}" for a in attrs)


#: Separates the classes, and no gain is higher by more than rounding explains (2^-51 a value).
FIRST = (
    "(NOT zero AND {gain} >= max({gain}) FILTER (NOT zero) OVER ({by})"
    " - (max(n_values) OVER ({by}) + 4) * 4.440892098500626e-16)"
)


def attr_ord(c: str) -> str:
    return "CASE " + " ".join(f"WHEN {c} = '{a}' THEN {i}" for i, a in enumerate(A)) + " END"


def value_case(split: str, rel: str) -> str:
    return f"CASE {split} " + " ".join(f"WHEN '{a}' THEN {rel}.{a}" for a in A) + " END"


def bootstrap_cte(src: str, n_trees: int, steps: list[int]) -> str:
    """``boot_cells``: weighted class counts per tree; a row's weight is the number of steps its draw reaches."""
    cols = ", ".join(A)
    weight = " + ".join(f"CAST(draw >= {x} AS BIGINT)" for x in steps)
    draw = "('0x' || substr(md5(key || '|' || CAST(tree AS VARCHAR)), 1, 8))::BIGINT % 1000000"
    return (
        f"boot_cells AS (SELECT tree, {cols}, CAST(coalesce(sum(w) FILTER (is_vote_helpful), 0) AS BIGINT) AS pos, "
        f"CAST(coalesce(sum(w) FILTER (NOT is_vote_helpful), 0) AS BIGINT) AS neg FROM (SELECT *, {weight} AS w FROM ("
        f"SELECT *, {draw} AS draw FROM {src}, (SELECT CAST(range AS INTEGER) AS tree FROM range({n_trees})))) "
        f"WHERE w > 0 GROUP BY tree, {cols})"
    )


def tree_ctes(src: str, p: str = "", forest: bool = False) -> str:
    """CTEs growing the tree over relation ``src``; the last is ``{p}tree``.

    With ``forest``, ``src`` are cells with a column ``tree``, and every tree is grown.
    """
    k = len(A)
    cols = ", ".join(A)
    o_cols = ", ".join(f"o.{a}" for a in A)
    root = "'root#' || CAST(tree AS VARCHAR)" if forest else "'root'"
    tree, s_tree = ("tree, ", "s.tree, ") if forest else ("", "")
    parts = [
        f"{p}cells AS (SELECT * FROM {src})" if forest else cells_cte(src, f"{p}cells"),
        f"{p}oc0 AS (SELECT {root} AS node_id, []::VARCHAR[] AS used, {cols}, pos, neg FROM {p}cells)",
        f"{p}n0 AS (SELECT {tree}{root} AS node_id, NULL::VARCHAR AS parent_id, 0 AS depth, NULL::VARCHAR AS edge_attr, "
        f"NULL::VARCHAR AS edge_value, '' AS rule, []::VARCHAR[] AS used, "
        f"CAST(coalesce(sum(pos), 0) AS BIGINT) AS pos, CAST(coalesce(sum(neg), 0) AS BIGINT) AS neg FROM {p}cells"
        f"{' GROUP BY tree' if forest else ''})",
    ]
    for d in range(k + 1):
        unions = " UNION ALL ".join(
            f"SELECT node_id, used, '{a}' AS attr, {a} AS value, pos, neg FROM {p}oc{d}" for a in A
        )
        parts.append(
            f"{p}cand{d} AS (SELECT node_id, attr, value, CAST(sum(pos) AS BIGINT) AS pos, CAST(sum(neg) AS BIGINT) AS neg "
            f"FROM ({unions}) u WHERE NOT list_contains(used, attr) GROUP BY node_id, attr, value)"
        )
        parts.append(
            f"{p}st{d} AS (SELECT c.node_id, c.attr, "
            f"{H('n.pos', 'n.neg')} - sum(CAST(c.pos + c.neg AS DOUBLE) * {H('c.pos', 'c.neg')}) / CAST(n.pos + n.neg AS DOUBLE) AS gain, "
            f"bool_and(CAST(c.pos AS HUGEINT) * n.neg = CAST(c.neg AS HUGEINT) * n.pos) AS zero, count(*) AS n_values "
            f"FROM {p}cand{d} c JOIN {p}n{d} n ON c.node_id = n.node_id GROUP BY c.node_id, c.attr, n.pos, n.neg)"
        )
        parts.append(
            f"{p}b{d} AS (SELECT node_id, attr AS best_attr, gain AS best_gain, zero AS best_zero FROM ("
            f"SELECT *, row_number() OVER (PARTITION BY node_id ORDER BY first DESC, {attr_ord('attr')}) AS rn "
            f"FROM (SELECT *, {FIRST.format(by='PARTITION BY node_id', gain='gain')} AS first FROM {p}st{d})) WHERE rn = 1)"
        )
        parts.append(
            f"{p}dec{d} AS (SELECT n.*, CASE WHEN n.depth = 0 AND b.best_attr IS NOT NULL THEN 'split' "
            f"WHEN n.pos = 0 OR n.neg = 0 THEN 'pure' WHEN b.best_attr IS NULL THEN 'exhausted' "
            f"WHEN b.best_zero THEN 'zero_gain' ELSE 'split' END AS kind, b.best_attr, b.best_gain "
            f"FROM {p}n{d} n LEFT JOIN {p}b{d} b ON n.node_id = b.node_id)"
        )
        if d < k:
            parts.append(
                f"{p}n{d + 1} AS (SELECT {s_tree}md5(c.node_id || '|' || c.attr || '=' || c.value) AS node_id, "
                f"c.node_id AS parent_id, s.depth + 1 AS depth, c.attr AS edge_attr, c.value AS edge_value, "
                f"CASE WHEN s.rule = '' THEN c.attr || '=' || c.value ELSE s.rule || ' AND ' || c.attr || '=' || c.value END AS rule, "
                f"list_append(s.used, c.attr) AS used, c.pos, c.neg "
                f"FROM {p}cand{d} c JOIN {p}dec{d} s ON c.node_id = s.node_id AND c.attr = s.best_attr WHERE s.kind = 'split')"
            )
            parts.append(
                f"{p}oc{d + 1} AS (SELECT md5(o.node_id || '|' || s.best_attr || '=' || ({value_case('s.best_attr', 'o')})) AS node_id, "
                f"list_append(o.used, s.best_attr) AS used, {o_cols}, o.pos, o.neg "
                f"FROM {p}oc{d} o JOIN {p}dec{d} s ON o.node_id = s.node_id WHERE s.kind = 'split')"
            )
    levels = " UNION ALL ".join(
        f"SELECT {tree}node_id, parent_id, depth, edge_attr, edge_value, rule, "
        f"CASE WHEN kind = 'split' THEN best_attr END AS split_attr, "
        f"CASE WHEN kind = 'split' THEN best_gain END AS gain, pos, neg, kind, pos > neg AS label FROM {p}dec{d}"
        for d in range(k + 1)
    )
    parts.append(f"{p}tree AS ({levels})")
    return ",\n".join(parts)


def walk_ctes(rows: str, tree: str, root: str = "'root'") -> str:
    """Prediction walk of ``rows`` through ``tree``; the last CTE is ``walked``."""
    k = len(A)
    parts = [
        f"w0 AS (SELECT r.*, {root} AS _cur, NULL::VARCHAR AS _node, NULL::VARCHAR AS _split, "
        f"NULL::BOOLEAN AS _label, NULL::INTEGER AS _depth FROM {rows} r)"
    ]
    for i in range(k + 1):
        parts.append(
            f"w{i + 1} AS (SELECT w.* REPLACE ("
            f"CASE WHEN t.node_id IS NOT NULL AND t.split_attr IS NOT NULL THEN "
            f"md5(w._cur || '|' || t.split_attr || '=' || coalesce({value_case('t.split_attr', 'w')}, 'false')) END AS _cur, "
            f"CASE WHEN t.node_id IS NOT NULL THEN t.node_id ELSE w._node END AS _node, "
            f"CASE WHEN t.node_id IS NOT NULL THEN t.split_attr ELSE w._split END AS _split, "
            f"CASE WHEN t.node_id IS NOT NULL THEN t.label ELSE w._label END AS _label, "
            f"CASE WHEN t.node_id IS NOT NULL THEN t.depth ELSE w._depth END AS _depth) "
            f"FROM w{i} w LEFT JOIN {tree} t ON w._cur = t.node_id)"
        )
    parts.append(
        f"walked AS (SELECT *, CASE WHEN coalesce(_label, false) THEN 'true' ELSE 'false' END AS prediction, "
        f"_depth AS matched_depth, _split IS NULL AS reached_leaf FROM w{k + 1})"
    )
    return ",\n".join(parts)


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


SL = sides(L_BASE)
SD = sides(D_BASE)
TREE_COLS = "node_id, parent_id, depth, edge_attr, edge_value, rule, split_attr, " + r9("gain") + " AS gain, pos, neg, kind, label"
ROOT_LONG = f"lc AS (SELECT attr, value, CAST(sum(pos) AS BIGINT) AS pos, CAST(sum(neg) AS BIGINT) AS neg FROM ({long_union('cells', [], A)}) u GROUP BY attr, value)"
# every value has the parent's class ratio, in whole numbers; p and n are the parent's counts
ZERO = "bool_and(CAST(pos AS HUGEINT) * n = CAST(neg AS HUGEINT) * p) AS zero, count(*) AS n_values"
ROOT_GAIN = (
    f"g AS (SELECT attr, {H('sum(pos)', 'sum(neg)')} - sum(CAST(pos + neg AS DOUBLE) * {H('pos', 'neg')}) "
    f"/ CAST(sum(pos) + sum(neg) AS DOUBLE) AS info_gain, {ZERO} "
    f"FROM (SELECT *, sum(pos) OVER (PARTITION BY attr) AS p, sum(neg) OVER (PARTITION BY attr) AS n FROM lc) GROUP BY attr)"
)
ROOT_BEST = (
    f"rb AS (SELECT attr, info_gain FROM (SELECT *, row_number() OVER (ORDER BY first DESC, {attr_ord('attr')}) AS rn "
    f"FROM (SELECT *, {FIRST.format(by='', gain='info_gain')} AS first FROM g)) WHERE rn = 1)"
)


def _level1() -> str:
    """Gains per child of the root (root attribute chosen in SQL)."""
    root_val = value_case("(SELECT attr FROM rb)", "cells")
    rest_unions = " UNION ALL ".join(
        f"SELECT {root_val} AS parent_value, '{a}' AS attr, {a} AS value, pos, neg FROM cells "
        f"WHERE '{a}' <> (SELECT attr FROM rb)"
        for a in A
    )
    return (
        f"l1 AS (SELECT parent_value, attr, value, CAST(sum(pos) AS BIGINT) AS pos, CAST(sum(neg) AS BIGINT) AS neg "
        f"FROM ({rest_unions}) u GROUP BY parent_value, attr, value),\n"
        f"g1 AS (SELECT parent_value, attr, {H('sum(pos)', 'sum(neg)')} - sum(CAST(pos + neg AS DOUBLE) * {H('pos', 'neg')}) "
        f"/ CAST(sum(pos) + sum(neg) AS DOUBLE) AS info_gain, {ZERO} FROM (SELECT *, "
        f"sum(pos) OVER (PARTITION BY parent_value, attr) AS p, sum(neg) OVER (PARTITION BY parent_value, attr) AS n FROM l1) "
        f"GROUP BY parent_value, attr)"
    )


def _domain(domains: dict, rel: str) -> str:
    parts = []
    for a, vals in domains.items():
        lst = ", ".join("'" + v.replace("'", "''") + "'" for v in vals)
        parts.append(f"SELECT '{a}' AS attr, {a} AS value FROM {rel} WHERE {a} IS NULL OR {a} NOT IN ({lst})")
    return " UNION ALL ".join(parts)


def cut_rows(src: str, by: list[str], value: str) -> str:
    """Every cut ``v`` of ``value`` but the greatest, per group: left counts, gain, and whether both sides have one class ratio."""
    g = "".join(f"{c}, " for c in by)
    part = f"PARTITION BY {', '.join(by)} " if by else ""
    return (
        f"SELECT *, {H('pos', 'neg')} - (CAST(left_pos + left_neg AS DOUBLE) * {H('left_pos', 'left_neg')} "
        f"+ CAST(pos - left_pos + neg - left_neg AS DOUBLE) * {H('(pos - left_pos)', '(neg - left_neg)')}) / CAST(pos + neg AS DOUBLE) AS gain, "
        f"CAST(left_pos AS HUGEINT) * (pos + neg) = CAST(pos AS HUGEINT) * (left_pos + left_neg) AS same FROM ("
        f"SELECT {g}'{value}' AS attr, v AS threshold, CAST(sum(p) OVER ({part}ORDER BY v) AS BIGINT) AS left_pos, "
        f"CAST(sum(n) OVER ({part}ORDER BY v) AS BIGINT) AS left_neg, CAST(sum(p) OVER ({part}) AS BIGINT) AS pos, "
        f"CAST(sum(n) OVER ({part}) AS BIGINT) AS neg, count(*) OVER ({part}) AS n_values FROM ("
        f"SELECT {g}CAST({value} AS DOUBLE) AS v, count_if(is_vote_helpful) AS p, count_if(NOT is_vote_helpful) AS n "
        f"FROM {src} GROUP BY ALL)) WHERE left_pos + left_neg < pos + neg"
    )


def best_cut_rows(src: str, by: list[str], value: str) -> str:
    part = f"PARTITION BY {', '.join(by)}" if by else ""
    return (
        f"SELECT * EXCLUDE (same), bool_and(same) OVER ({part}) AS zero FROM ({cut_rows(src, by, value)}) "
        f"QUALIFY row_number() OVER ({part} ORDER BY same, round(gain, 12) DESC, threshold) = 1"
    )


def mixed_tree_ctes(src: str, categories: tuple, numbers: tuple, max_depth: int, min_rows: int) -> str:
    """CTEs growing a tree over categories and cut numbers; the last is ``mixed``."""
    cols = ", ".join([*categories, *numbers, "is_vote_helpful"])
    names = [*categories, *numbers]
    parts = [
        f"m0 AS (SELECT 'root' AS node_id, NULL::VARCHAR AS parent_id, NULL::VARCHAR AS edge_attr, NULL::VARCHAR AS edge_value, "
        f"[]::VARCHAR[] AS used, {cols} FROM {src})"
    ]
    place = "CASE attr " + " ".join(f"WHEN '{a}' THEN {i}" for i, a in enumerate(names)) + " END"
    for d in range(max_depth + 1):
        parts.append(
            f"t{d} AS (SELECT node_id, parent_id, edge_attr, edge_value, CAST(count_if(is_vote_helpful) AS BIGINT) AS pos, "
            f"CAST(count_if(NOT is_vote_helpful) AS BIGINT) AS neg FROM m{d} GROUP BY ALL)"
        )
        if d == max_depth:
            parts.append(f"x{d} AS (SELECT *, NULL::VARCHAR AS attr, NULL::DOUBLE AS threshold, NULL::DOUBLE AS gain, true AS zero FROM t{d})")
        else:
            unions = " UNION ALL ".join(
                f"SELECT node_id, '{a}' AS attr, {a} AS value, count_if(is_vote_helpful) AS p, count_if(NOT is_vote_helpful) AS n "
                f"FROM m{d} WHERE NOT list_contains(used, '{a}') GROUP BY ALL"
                for a in categories
            )
            parts.append(
                f"c{d} AS (SELECT u.node_id, attr, NULL::DOUBLE AS threshold, "
                f"any_value({H('t.pos', 't.neg')}) - sum(CAST(p + n AS DOUBLE) * {H('p', 'n')}) / CAST(any_value(t.pos + t.neg) AS DOUBLE) AS gain, "
                f"bool_and(CAST(p AS HUGEINT) * (t.pos + t.neg) = CAST(t.pos AS HUGEINT) * (p + n)) AS zero "
                f"FROM ({unions}) u JOIN t{d} t ON u.node_id = t.node_id GROUP BY u.node_id, attr)"
            )
            cuts = "".join(
                f" UNION ALL SELECT node_id, attr, threshold, gain, zero FROM ({best_cut_rows(f'm{d}', ['node_id'], v)})" for v in numbers
            )
            parts.append(
                f"b{d} AS (SELECT * FROM (SELECT * FROM c{d}{cuts}) QUALIFY row_number() OVER ("
                f"PARTITION BY node_id ORDER BY zero, round(gain, 12) DESC, {place}) = 1)"
            )
            parts.append(f"x{d} AS (SELECT t.*, b.attr, b.threshold, b.gain, b.zero FROM t{d} t LEFT JOIN b{d} b ON t.node_id = b.node_id)")
        parts.append(
            f"d{d} AS (SELECT *, CASE WHEN pos = 0 OR neg = 0 THEN 'pure' WHEN {d} = {max_depth} THEN 'depth' "
            f"WHEN pos + neg < {min_rows} THEN 'small' WHEN coalesce(zero, true) THEN 'zero_gain' ELSE 'split' END AS kind FROM x{d})"
        )
        if d < max_depth:
            edge = "CASE d.attr " + " ".join(f"WHEN '{a}' THEN m.{a}" for a in categories)
            edge += " " + " ".join(f"WHEN '{v}' THEN (CASE WHEN m.{v} <= d.threshold THEN '<=' ELSE '>' END)" for v in numbers) + " END"
            own = ", ".join(f"m.{c}" for c in [*categories, *numbers, "is_vote_helpful"])
            parts.append(
                f"m{d + 1} AS (SELECT md5(m.node_id || '|' || d.attr || '=' || ({edge})) AS node_id, m.node_id AS parent_id, d.attr AS edge_attr, "
                f"({edge}) AS edge_value, CASE WHEN d.threshold IS NULL THEN list_append(m.used, d.attr) ELSE m.used END AS used, {own} "
                f"FROM m{d} m JOIN d{d} d ON m.node_id = d.node_id WHERE d.kind = 'split')"
            )
    levels = " UNION ALL ".join(
        f"SELECT node_id, parent_id, {d} AS depth, edge_attr, edge_value, CASE WHEN kind = 'split' THEN attr END AS split_attr, "
        f"CASE WHEN kind = 'split' THEN threshold END AS threshold, CASE WHEN kind = 'split' THEN gain END AS gain, pos, neg, kind, "
        f"pos > neg AS label FROM d{d}"
        for d in range(max_depth + 1)
    )
    return ",\n".join([*parts, f"mixed AS ({levels})"])


def mixed_walk_ctes(rows: str, categories: tuple, numbers: tuple, max_depth: int) -> str:
    parts = [f"y0 AS (SELECT r.*, 'root' AS _cur, NULL::BOOLEAN AS _label, NULL::INTEGER AS _depth FROM {rows} r)"]
    edge = "CASE t.split_attr " + " ".join(f"WHEN '{a}' THEN y.{a}" for a in categories)
    edge += " " + " ".join(f"WHEN '{v}' THEN (CASE WHEN y.{v} <= t.threshold THEN '<=' ELSE '>' END)" for v in numbers) + " END"
    for d in range(max_depth + 1):
        parts.append(
            f"y{d + 1} AS (SELECT y.* REPLACE (md5(y._cur || '|' || t.split_attr || '=' || ({edge})) AS _cur, "
            f"coalesce(t.label, y._label) AS _label, coalesce(t.depth, y._depth) AS _depth) "
            f"FROM y{d} y LEFT JOIN mixed t ON y._cur = t.node_id)"
        )
    return ",\n".join(parts)


def prune_ctes() -> str:
    """CTEs after ``walk_ctes`` that fold the tree from below; the last is ``pruned``."""
    k = len(A)
    visits = " UNION ALL ".join(f"SELECT t.node_id, w.is_vote_helpful FROM w{i} w JOIN tree t ON w._cur = t.node_id" for i in range(k + 1))
    parts = [
        f"reach AS (SELECT node_id, CAST(count_if(is_vote_helpful) AS BIGINT) AS rp, CAST(count_if(NOT is_vote_helpful) AS BIGINT) AS rn "
        f"FROM ({visits}) v GROUP BY node_id)",
        "rt AS (SELECT t.*, coalesce(rp, 0) AS reach_pos, coalesce(rn, 0) AS reach_neg FROM tree t LEFT JOIN reach r ON t.node_id = r.node_id)",
    ]
    for d in range(k, -1, -1):
        below = f"SELECT parent_id, sum(errors) AS e, sum(reach_pos) AS p, sum(reach_neg) AS n FROM f{d + 1} GROUP BY parent_id"
        if d == k:
            below = "SELECT NULL::VARCHAR AS parent_id, 0 AS e, 0 AS p, 0 AS n WHERE false"
        parts.append(
            f"f{d} AS (SELECT *, CAST(least(as_leaf, subtree) AS BIGINT) AS errors, split_attr IS NOT NULL AND as_leaf <= subtree AS cut FROM ("
            f"SELECT rt.*, CASE WHEN label THEN reach_neg ELSE reach_pos END AS as_leaf, "
            f"CASE WHEN split_attr IS NULL THEN CASE WHEN label THEN reach_neg ELSE reach_pos END ELSE "
            f"coalesce(e, 0) + CASE WHEN label THEN reach_neg - coalesce(n, 0) ELSE reach_pos - coalesce(p, 0) END END AS subtree "
            f"FROM rt LEFT JOIN ({below}) b ON rt.node_id = b.parent_id WHERE rt.depth = {d}))"
        )
    parts.append("k0 AS (SELECT * FROM f0)")
    for d in range(1, k + 1):
        parts.append(
            f"k{d} AS (SELECT f.* FROM f{d} f WHERE f.parent_id IN (SELECT node_id FROM k{d - 1} WHERE NOT cut AND split_attr IS NOT NULL))"
        )
    kept = " UNION ALL ".join(f"SELECT * FROM k{d}" for d in range(k + 1))
    parts.append(f"pruned AS ({kept})")
    return ",\n".join(parts)


def forest_ctes(base: str, n_trees: int, steps: list[int]) -> list[str]:
    """Bootstraps, trees and one walk for every pair of a test row and a tree."""
    rows = f"test_trees AS (SELECT * FROM (SELECT *, row_number() OVER () AS r_id FROM test), (SELECT CAST(range AS INTEGER) AS tree FROM range({n_trees})))"
    walk = walk_ctes("test_trees", "tree", "'root#' || CAST(r.tree AS VARCHAR)")
    return [base, bootstrap_cte("train", n_trees, steps), tree_ctes("boot_cells", forest=True), rows, walk]


def oracle_sql() -> dict[str, str]:
    from canopy.operators.forest import N_TREES, poisson_steps
    from canopy.plans.queries import (
        CATEGORIES,
        DOMAINS_D,
        DOMAINS_L,
        MIXED_DEPTH,
        MIXED_ROWS,
        NUMBERS,
        PATH_L,
        UNSEEN_LANG,
    )

    path = " AND ".join(f"{a} = '{v}'" for a, v in PATH_L)
    sq: dict[str, str] = {}
    sq["scan_project"] = (
        "SELECT d.doc_id, lang AS marketplace, CAST(quality AS VARCHAR) AS verified_purchase, "
        "CAST(toxic AS VARCHAR) AS vine, source AS product_category, "
        "CAST(length(regexp_replace(text, '[^aeiou]', '', 'g')) AS BIGINT) AS helpful_votes, n_chars AS total_votes "
        "FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"
    )
    sq["row_count"] = f"SELECT count(*) AS n_rows FROM ({L_BASE}) t"
    sq["ratio_target"] = (
        "SELECT l_orderkey, l_linenumber, l_tax / nullif(l_discount, 0) AS ratio, "
        "coalesce(l_tax / nullif(l_discount, 0) > 0.5, false) AS is_vote_helpful FROM lineitem"
    )
    sq["flag_to_boolean"] = (
        "SELECT l_orderkey, l_linenumber, coalesce(l_linestatus = 'F', false) AS verified_flag FROM lineitem"
    )
    sq["fill_missing"] = f"SELECT doc_id, marketplace, verified_purchase, vine, product_category FROM ({D_BASE}) t"
    sq["rating_bucket"] = (
        "SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber < 2 THEN 'bad' WHEN l_linenumber = 3 THEN 'regular' "
        "ELSE 'good' END AS star_rating FROM lineitem"
    )
    sq["text_length"] = f"SELECT doc_id, body_len AS review_body FROM ({D_BASE}) t"
    sq["row_index"] = "SELECT doc_id, CAST(row_number() OVER (ORDER BY doc_id) - 1 AS BIGINT) AS row_index FROM documents"
    sq["split_train_test"] = _with(f"base AS ({L_BASE})") + (
        f"SELECT CASE WHEN {bucket('key')} < 70 THEN 'train' ELSE 'test' END AS side, count(*) AS n_rows, "
        "CAST(count_if(is_vote_helpful) AS BIGINT) AS n_pos, CAST(count_if(NOT is_vote_helpful) AS BIGINT) AS n_neg "
        "FROM base GROUP BY 1"
    )
    sq["quartile_cuts"] = _with(SL) + (
        "SELECT 'train' AS side, q1, q2, q3 FROM cut_tr UNION ALL SELECT 'test' AS side, q1, q2, q3 FROM cut_te"
    )
    sq["quartile_cuts_approx"] = _with(SL) + (
        "SELECT 'train' AS side, min(body_len) AS q1, max(body_len) AS q3, true AS q2_within_bound FROM tr "
        "UNION ALL SELECT 'test' AS side, min(body_len) AS q1, max(body_len) AS q3, true AS q2_within_bound FROM te"
    )
    sq["discretize_train"] = _with(SL) + "SELECT l_orderkey, l_linenumber, body_len, review_body FROM train"
    sq["discretize_test"] = _with(SL) + "SELECT l_orderkey, l_linenumber, body_len, review_body FROM test"
    sq["class_counts"] = _with(SL) + (
        "SELECT CAST(count_if(is_vote_helpful) AS BIGINT) AS pos, CAST(count_if(NOT is_vote_helpful) AS BIGINT) AS neg, "
        "count(*) AS total FROM train"
    )
    sq["path_filter"] = _with(SL) + f"SELECT l_orderkey, l_linenumber, is_vote_helpful FROM train WHERE {path}"
    sq["distinct_values"] = _with(SD) + "SELECT DISTINCT product_category FROM train"
    avc = _with(SL, cells_cte("train"), ROOT_LONG) + (
        "SELECT attr, value, pos AS helpful_count, neg AS not_helpful_count, pos + neg AS total FROM lc"
    )
    sq["attr_value_counts"] = avc
    sq["attr_value_counts_join"] = avc
    sq["domain_check"] = _with(SL) + (
        f"SELECT attr, value, count(*) AS n_rows FROM ({_domain(DOMAINS_L, 'train')}) u GROUP BY attr, value"
    )
    sq["domain_check_nulls"] = _with(f"raw AS ({sq['scan_project']})") + (
        f"SELECT attr, value, count(*) AS n_rows FROM ({_domain(DOMAINS_D, 'raw')}) u GROUP BY attr, value"
    )
    sq["node_split_deep"] = _with(SL, cells_cte("train")) + (
        "SELECT 'product_category' AS attr, product_category AS value, CAST(sum(pos) AS BIGINT) AS pos, "
        f"CAST(sum(neg) AS BIGINT) AS neg FROM cells WHERE {path} GROUP BY product_category"
    )
    sq["leaf_labels_path"] = _with(SL, cells_cte("train")) + (
        f"SELECT DISTINCT label FROM (SELECT true AS label FROM cells WHERE pos > 0 AND {path} "
        f"UNION ALL SELECT false AS label FROM cells WHERE neg > 0 AND {path})"
    )
    sq["cells"] = _with(SL, cells_cte("train")) + f"SELECT {', '.join(A)}, pos, neg FROM cells"
    sq["entropy"] = _with(SL, cells_cte("train"), ROOT_LONG) + f"SELECT attr, value, {r9(H('pos', 'neg'))} AS entropy FROM lc"
    sq["info_gain"] = _with(SD, cells_cte("train"), ROOT_LONG, ROOT_GAIN) + f"SELECT attr, {r9('info_gain')} AS info_gain FROM g"
    sq["best_attribute"] = _with(SD, cells_cte("train"), ROOT_LONG, ROOT_GAIN, ROOT_BEST) + (
        f"SELECT attr, {r9('info_gain')} AS info_gain FROM rb"
    )
    sq["node_split"] = _with(SD, cells_cte("train"), ROOT_LONG, ROOT_GAIN, ROOT_BEST) + (
        "SELECT attr, value, pos, neg FROM lc WHERE attr = (SELECT attr FROM rb)"
    )
    sq["node_info_gain"] = _with(SD, cells_cte("train"), ROOT_LONG, ROOT_GAIN, ROOT_BEST, _level1()) + (
        f"SELECT parent_value, attr, {r9('info_gain')} AS info_gain FROM g1"
    )
    sq["node_best_attribute"] = _with(SD, cells_cte("train"), ROOT_LONG, ROOT_GAIN, ROOT_BEST, _level1()) + (
        f"SELECT parent_value, attr, {r9('info_gain')} AS info_gain FROM (SELECT *, row_number() OVER "
        f"(PARTITION BY parent_value ORDER BY first DESC, {attr_ord('attr')}) AS rn FROM (SELECT *, "
        f"{FIRST.format(by='PARTITION BY parent_value', gain='info_gain')} AS first FROM g1)) WHERE rn = 1"
    )
    sq["leaf_labels"] = _with(SD, cells_cte("train"), ROOT_LONG, ROOT_GAIN, ROOT_BEST) + (
        "SELECT value AS parent_value, true AS label FROM lc WHERE attr = (SELECT attr FROM rb) AND pos > 0 "
        "UNION ALL SELECT value AS parent_value, false AS label FROM lc WHERE attr = (SELECT attr FROM rb) AND neg > 0"
    )
    sq["id3_tree"] = _with(SD, tree_ctes("train")) + f"SELECT {TREE_COLS} FROM tree"
    sq["id3_tree_lineitem"] = _with(SL, tree_ctes("train")) + f"SELECT {TREE_COLS} FROM tree"
    sq["tree_rules"] = _with(SD, tree_ctes("train")) + (
        "SELECT rule, label, pos, neg, kind, depth FROM tree WHERE split_attr IS NULL"
    )
    sq["predict"] = _with(SD, tree_ctes("train"), walk_ctes("test", "tree")) + (
        "SELECT doc_id, prediction, matched_depth, reached_leaf FROM walked"
    )
    sq["predict_unseen"] = _with(
        SD, f"train_seen AS (SELECT * FROM train WHERE marketplace <> '{UNSEEN_LANG}')", tree_ctes("train_seen"), walk_ctes("test", "tree")
    ) + "SELECT doc_id, prediction, matched_depth, reached_leaf FROM walked"
    sq["squared_error"] = _with(SD, tree_ctes("train"), walk_ctes("test", "tree")) + (
        "SELECT doc_id, CAST(power(CAST(is_vote_helpful AS INTEGER) - CAST(prediction = 'true' AS INTEGER), 2) AS DOUBLE) "
        "AS squared_error FROM walked"
    )
    mse = (
        f"SELECT {r9('avg(CAST(power(CAST(is_vote_helpful AS INTEGER) - CAST(prediction = ' + chr(39) + 'true' + chr(39) + ' AS INTEGER), 2) AS DOUBLE))')} "
        "AS mse, count(*) AS n_rows FROM walked"
    )
    sq["mean_squared_error"] = _with(SD, tree_ctes("train"), walk_ctes("test", "tree")) + mse
    sq["class_report"] = _with(SD, tree_ctes("train"), walk_ctes("test", "tree")) + (
        f"SELECT class, n_rows, n_predicted, hits, {r9('hits / nullif(n_predicted, 0)')} AS precision, "
        f"{r9('hits / nullif(n_rows, 0)')} AS recall, {r9('2 * hits / nullif(n_rows + n_predicted, 0)')} AS f1 FROM ("
        "SELECT class, count_if(CAST(is_vote_helpful AS VARCHAR) = class)::BIGINT AS n_rows, count_if(prediction = class)::BIGINT AS n_predicted, "
        "count_if(CAST(is_vote_helpful AS VARCHAR) = class AND prediction = class)::BIGINT AS hits "
        "FROM (VALUES ('true'), ('false')) c(class), walked GROUP BY class)"
    )
    sq["mean_squared_error_lineitem"] = _with(SL, tree_ctes("train"), walk_ctes("test", "tree")) + mse
    sq["prediction_truth_join"] = _with(SD, tree_ctes("train"), walk_ctes("test", "tree")) + (
        "SELECT doc_id, is_vote_helpful, prediction FROM walked"
    )
    cut_cols = f"marketplace, attr, threshold, {r9('gain')} AS gain, left_pos, left_neg, pos, neg, n_values, zero"
    sq["continuous_cuts"] = _with(SL) + " UNION ALL ".join(
        f"SELECT {cut_cols} FROM ({best_cut_rows('tr', ['marketplace'], v)})" for v in NUMBERS
    )
    mixed = mixed_tree_ctes("tr", CATEGORIES, NUMBERS, MIXED_DEPTH, MIXED_ROWS)
    sq["continuous_tree"] = _with(SL, mixed) + f"SELECT * REPLACE ({r9('gain')} AS gain) FROM mixed"
    sq["continuous_predict"] = _with(SL, mixed, mixed_walk_ctes("te", CATEGORIES, NUMBERS, MIXED_DEPTH)) + (
        "SELECT l_orderkey, l_linenumber, is_vote_helpful, CASE WHEN _label THEN 'true' ELSE 'false' END AS prediction, "
        f"_depth AS matched_depth FROM y{MIXED_DEPTH + 1}"
    )
    pruned = (
        "SELECT node_id, parent_id, depth, edge_attr, edge_value, rule, CASE WHEN NOT cut THEN split_attr END AS split_attr, "
        f"CASE WHEN NOT cut THEN {r9('gain')} END AS gain, pos, neg, CASE WHEN cut THEN 'pruned' ELSE kind END AS kind, label, "
        "reach_pos, reach_neg, errors FROM pruned"
    )
    for key, base in (("pruned_tree", SD), ("pruned_tree_lineitem", SL)):
        sq[key] = _with(base, tree_ctes("train"), walk_ctes("test", "tree"), prune_ctes()) + pruned
    on_d, on_l = (forest_ctes(base, N_TREES, poisson_steps()) for base in (SD, SL))
    sq["forest_trees"] = _with(*on_d[:3]) + f"SELECT tree, {TREE_COLS} FROM tree"
    sq["forest_trees_lineitem"] = _with(*on_l[:3]) + f"SELECT tree, {TREE_COLS} FROM tree"
    votes = "count_if(_label) AS votes, count(_label) AS n_votes, any_value(is_vote_helpful) AS truth FROM walked"
    said = "CASE WHEN 2 * votes > n_votes THEN 'true' ELSE 'false' END"
    sq["forest_predict"] = _with(*on_d) + (
        f"SELECT doc_id, {said} AS prediction, CAST(votes AS BIGINT) AS votes, n_votes FROM (SELECT doc_id, {votes} GROUP BY doc_id)"
    )
    sq["forest_error_lineitem"] = _with(*on_l) + (
        f"SELECT {r9(f'avg(CAST({said} <> CAST(truth AS VARCHAR) AS INTEGER))')} AS mse, count(*) AS n_rows FROM ("
        f"SELECT {votes} GROUP BY r_id)"
    )
    return sq
