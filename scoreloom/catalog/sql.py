"""Shared SQL blocks of the check queries, joined by name with what they depend on."""

from __future__ import annotations

from scoreloom.functions.text import DESCRIPTOR_NAMES, KEY_PATTERNS

N_KEYS = len(KEY_PATTERNS)
N_DESC = len(DESCRIPTOR_NAMES)
BITS = 1024


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def slot(text: str, size: str | int) -> str:
    return f"(CAST('0x' || substr(md5({text}), 1, 15) AS BIGINT) % {size})"


_BLANK = r"'[ \t\n\r\f]+'"
_TOKENS = f"[x for x in regexp_split_to_array(text, {_BLANK}) if x <> '']"


def _share(top: str, bottom: str) -> str:
    return f"CASE WHEN {bottom} = 0 THEN 0.0 ELSE CAST({top} AS DOUBLE) / {bottom} END"


def _class(chars: str) -> str:
    return f"length(regexp_replace(text, '[^{chars}]', '', 'g'))"


_DESC_SQL = {
    "n_chars": "CAST(length(text) AS DOUBLE)",
    "n_tokens": "CAST(len(t) AS DOUBLE)",
    "n_lines": "CAST(len(string_split(text, chr(10))) AS DOUBLE)",
    "mean_token_len": "CAST(list_sum([length(x) for x in t]) AS DOUBLE) / len(t)",
    "max_token_len": "CAST(list_max([length(x) for x in t]) AS DOUBLE)",
    "distinct_token_ratio": "CAST(len(list_distinct(t)) AS DOUBLE) / len(t)",
    "distinct_line_ratio": "CAST(len(list_distinct(string_split(text, chr(10)))) AS DOUBLE) / len(string_split(text, chr(10)))",
    "letter_ratio": _share(_class("A-Za-z"), "length(text)"),
    "upper_ratio": _share(_class("A-Z"), "length(text)"),
    "digit_ratio": _share(_class("0-9"), "length(text)"),
    "punct_ratio": _share(_class(r"!-/:-@\[-`{-~"), "length(text)"),
    "blank_ratio": _share(_class(r" \t\n\r\f"), "length(text)"),
    "other_ratio": _share(
        "(length(text) - " + " - ".join(_class(c) for c in ("A-Za-z", "0-9", r"!-/:-@\[-`{-~", r" \t\n\r\f")) + ")",
        "length(text)",
    ),
    "token_entropy": "entropy",
}

OFFSET = {"ngram": 0, "keys": BITS, "desc": BITS + N_KEYS, "chargram": BITS + N_KEYS + N_DESC}

_CTE: dict[str, tuple[tuple[str, ...], str]] = {
    "docs": (
        (),
        "SELECT d.doc_id AS row_id, d.text, l.quality, l.toxic FROM documents d JOIN labels l ON d.doc_id = l.doc_id",
    ),
    "data": (
        ("docs",),
        "SELECT 'quality' AS dataset, row_id, quality AS target FROM docs"
        " UNION ALL SELECT 'toxic', row_id, toxic FROM docs",
    ),
    "pool": (
        ("data",),
        "SELECT dataset, row_id, target FROM data UNION ALL"
        " SELECT 'events', event_id, CAST(event_type = 'error' AS INTEGER) FROM events",
    ),
    # Text features of every document.
    "tok": ((), f"SELECT doc_id AS row_id, text, {_TOKENS} AS t FROM documents"),
    "ngram": (
        ("tok",),
        "SELECT DISTINCT row_id, " + slot("g", BITS) + " AS bit FROM ("
        "SELECT row_id, unnest(t) AS g FROM tok"
        " UNION ALL SELECT row_id, unnest([t[i] || ' ' || t[i + 1] for i in range(1, len(t))]) FROM tok"
        " UNION ALL SELECT row_id, unnest([t[i] || ' ' || t[i + 1] || ' ' || t[i + 2] for i in range(1, len(t) - 1)]) FROM tok)",
    ),
    "chargram": (
        ("tok",),
        "SELECT DISTINCT row_id, " + slot("g", BITS) + " AS bit FROM ("
        "SELECT row_id, unnest([c[i] || c[i + 1] || c[i + 2] || c[i + 3] for i in range(1, len(c) - 2)]) AS g"
        " FROM (SELECT row_id, regexp_extract_all(text, '(?s).') AS c FROM tok WHERE len(t) > 0))",
    ),
    "keys": (
        ("tok",),
        "SELECT row_id, bit FROM (" + " UNION ALL ".join(
            f"SELECT row_id, {i} AS bit FROM tok WHERE len(t) > 0 AND regexp_matches(text, {_quoted(p)})"
            for i, p in enumerate(KEY_PATTERNS)
        ) + ")",
    ),
    "entropy": (
        ("tok",),
        "SELECT row_id, -sum(m / n * log2(m / n)) AS entropy FROM ("
        "SELECT row_id, c, CAST(count(*) AS DOUBLE) AS m, CAST(sum(count(*)) OVER (PARTITION BY row_id) AS DOUBLE) AS n"
        " FROM (SELECT row_id, unnest(t) AS c FROM tok) GROUP BY row_id, c) GROUP BY row_id",
    ),
    "wide": (
        ("tok", "entropy"),
        "SELECT row_id, " + ", ".join(f"{e} AS {n}" for n, e in _DESC_SQL.items())
        + " FROM tok JOIN entropy USING (row_id) WHERE len(t) > 0",
    ),
    "descs": (
        ("wide",),
        " UNION ALL ".join(
            f"SELECT row_id, {i} AS bit, CAST({n} AS DOUBLE) AS x FROM wide" for i, n in enumerate(DESCRIPTOR_NAMES)
        ),
    ),
    # Sparse cells of the labelled datasets.
    "doc_cells": (
        ("ngram", "keys", "descs", "chargram"),
        " UNION ALL ".join(
            f"SELECT row_id, bit + {off} AS idx, {'x' if f == 'desc' else '1.0::DOUBLE'} AS x FROM {'descs' if f == 'desc' else f}" for f, off in OFFSET.items()
        ),
    ),
    "kd_cells": (
        ("keys", "descs"),
        f"SELECT row_id, bit AS idx, 1.0::DOUBLE AS x FROM keys UNION ALL SELECT row_id, bit + {N_KEYS}, x FROM descs",
    ),
    # Exact hold-out, inner validation and folds.
    "sizes": (
        ("pool",),
        "SELECT dataset, target, n, fl + CAST(row_number() OVER (PARTITION BY dataset ORDER BY rest DESC, target) <= test - fls AS BIGINT) AS take"
        " FROM (SELECT *, sum(fl) OVER (PARTITION BY dataset) AS fls FROM ("
        "SELECT dataset, target, n, test, (n * test) // total AS fl, (n * test) % total AS rest FROM ("
        "SELECT dataset, target, n, total, CAST(ceil(total * 0.2::DOUBLE) AS BIGINT) AS test FROM ("
        "SELECT dataset, target, count(*) AS n, CAST(sum(count(*)) OVER (PARTITION BY dataset) AS BIGINT) AS total"
        " FROM pool GROUP BY dataset, target))))",
    ),
    "split": (
        ("pool", "sizes"),
        "SELECT p.dataset, p.row_id, p.target, CASE WHEN rn <= take THEN 'test' ELSE 'train' END AS split FROM ("
        "SELECT *, row_number() OVER (PARTITION BY dataset, target ORDER BY md5('42:split:' || row_id), row_id) AS rn FROM pool) p"
        " JOIN sizes s ON p.dataset = s.dataset AND p.target = s.target",
    ),
    "train": (("split",), "SELECT dataset, row_id, target FROM split WHERE split = 'train'"),
    "inner_sizes": (
        ("train",),
        "SELECT dataset, target, fl + CAST(row_number() OVER (PARTITION BY dataset ORDER BY rest DESC, target) <= test - fls AS BIGINT) AS take"
        " FROM (SELECT *, sum(fl) OVER (PARTITION BY dataset) AS fls FROM ("
        "SELECT dataset, target, test, (n * test) // total AS fl, (n * test) % total AS rest FROM ("
        "SELECT dataset, target, n, total, CAST(ceil(total * 0.25::DOUBLE) AS BIGINT) AS test FROM ("
        "SELECT dataset, target, count(*) AS n, CAST(sum(count(*)) OVER (PARTITION BY dataset) AS BIGINT) AS total"
        " FROM train GROUP BY dataset, target))))",
    ),
    "inner_split": (
        ("train", "inner_sizes"),
        "SELECT p.dataset, p.row_id, p.target, CASE WHEN rn <= take THEN 'valid' ELSE 'fit' END AS \"inner\" FROM ("
        "SELECT *, row_number() OVER (PARTITION BY dataset, target ORDER BY md5('42:inner:' || row_id), row_id) AS rn FROM train) p"
        " JOIN inner_sizes s ON p.dataset = s.dataset AND p.target = s.target",
    ),
    "train_counts": (("train",), "SELECT dataset, target, count(*) AS n FROM train GROUP BY dataset, target"),
    "balance": (
        ("train_counts",),
        "SELECT dataset, CAST(sum(CASE WHEN target = 1 THEN n ELSE 0 END) AS DOUBLE) AS pos,"
        " CAST(sum(CASE WHEN target = 0 THEN n ELSE 0 END) AS DOUBLE) AS neg FROM train_counts GROUP BY dataset",
    ),
    # One descriptor used alone as a scorer, scaled on training rows.
    "scored": (
        ("split", "descs"),
        "SELECT s.dataset, s.row_id, s.target, s.split, d.bit AS view,"
        " CASE WHEN r.hi > r.lo THEN (d.x - r.lo) / (r.hi - r.lo) ELSE 0.0 END AS score"
        " FROM split s JOIN descs d ON s.row_id = d.row_id AND s.dataset <> 'events'"
        " JOIN (SELECT s.dataset, d.bit, min(d.x) AS lo, max(d.x) AS hi FROM split s JOIN descs d ON s.row_id = d.row_id"
        " WHERE s.split = 'train' AND s.dataset <> 'events' GROUP BY ALL) r ON r.dataset = s.dataset AND r.bit = d.bit",
    ),
}


def ctes(*names: str, extra: str = "") -> str:
    """`WITH` clause of the named blocks and all they depend on."""
    order: list[str] = []

    def visit(name: str) -> None:
        for dep in _CTE[name][0]:
            visit(dep)
        if name not in order:
            order.append(name)

    for name in names:
        visit(name)
    blocks = [f"{n} AS MATERIALIZED ({_CTE[n][1]})" for n in order]
    if extra:
        blocks.append(extra)
    return "WITH " + ",\n".join(blocks) + "\n"


def ladder(source: str, keys: str, name: str = "ladder") -> str:
    """Distinct-score table of `source` with running totals per `keys`."""
    return (
        f"{name} AS (SELECT *, sum(rows) OVER w AS cum_rows, sum(pos) OVER w AS cum_pos FROM ("
        f"SELECT {keys}, score, count(*)::DOUBLE AS rows, sum(target)::DOUBLE AS pos,"
        f" sum(prediction)::DOUBLE AS called, sum(prediction * target)::DOUBLE AS called_pos FROM {source} GROUP BY {keys}, score)"
        f" WINDOW w AS (PARTITION BY {keys} ORDER BY score DESC ROWS UNBOUNDED PRECEDING))"
    )


ROC = (
    "CASE WHEN sum(pos) * sum(rows - pos) > 0 THEN sum((rows - pos) * (cum_pos - pos / 2)) / (sum(pos) * sum(rows - pos)) END"
)
AP = "CASE WHEN sum(pos) > 0 THEN sum(pos * cum_pos / cum_rows) / sum(pos) ELSE 0.0 END"


def metric_block(name: str, ladder_name: str, keys: str) -> str:
    """All metrics per `keys` from a ladder."""
    return (
        f"{name}_c AS (SELECT {keys}, {ROC} AS ROC, {AP} AS AP, sum(rows - pos - called + called_pos) AS tn,"
        f" sum(called - called_pos) AS fp, sum(pos - called_pos) AS fn, sum(called_pos) AS tp FROM {ladder_name} GROUP BY {keys}),\n"
        f"{name} AS (SELECT {keys}, ROC, AP,"
        " CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0.0 END AS F1,"
        " (tp + tn) / (tp + tn + fp + fn) AS Accuracy,"
        " CASE WHEN tp + fn = 0 THEN tn / (tn + fp) WHEN tn + fp = 0 THEN tp / (tp + fn)"
        " ELSE (tp / (tp + fn) + tn / (tn + fp)) / 2 END AS BalancedAccuracy,"
        " CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS Recall,"
        " CASE WHEN tn + fp > 0 THEN tn / (tn + fp) END AS Specificity,"
        " CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS Precision,"
        f" CAST(tn AS BIGINT) AS TN, CAST(fp AS BIGINT) AS FP, CAST(fn AS BIGINT) AS FN, CAST(tp AS BIGINT) AS TP FROM {name}_c)"
    )


def rounded(*names: str, digits: int = 6) -> str:
    return ", ".join(f'round("{n}", {digits}) AS "{n}"' for n in names)
