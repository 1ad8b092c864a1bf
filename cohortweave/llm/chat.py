"""Reply trees to conversations: enumerate paths by self-joins, rank branches, format one text each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortweave.llm.blocks import stored

# Fixed values of the template.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def escaped(column: str) -> str:
    """SQL: one backslash more wherever only backslashes stand between < and |.

    The result never contains "<|", and taking one backslash away gives the text back.
    """
    return f"regexp_replace({column}, '<(\\\\\\\\*)\\\\|', '<$1\\\\\\\\|')"


def unescaped(column: str) -> str:
    return f"regexp_replace({column}, '<(\\\\\\\\*)\\\\\\\\\\\\|', '<$1|')"


def escaped_role(column: str) -> str:
    return f"replace(replace(replace({column}, '%', '%25'), '\\n', '%0A'), '|', '%7C')"


def unescaped_role(column: str) -> str:
    return f"replace(replace(replace({column}, '%7C', '|'), '%0A', '\\n'), '%25', '%')"


def _jumps(nodes: DataFrame) -> list[DataFrame]:
    """Rounds of rows (tree, node, jump, n, total) of pointer doubling over ``nodes`` (tree, node, parent, score).

    A row covers the ``n`` newest nodes of the path that ends in ``node`` and the sum of their scores; ``jump`` is
    the ancestor above them, NULL once the root is reached. Round k holds the nodes that no earlier round
    brought to a root, so its pointers lead 2**k nodes up. A node takes one row per round, never its path.
    """
    base = nodes.selectExpr("tree", "node", "parent", "coalesce(cast(score AS double), 0D) AS score")
    there = base.selectExpr("tree AS _t", "node AS _n")
    known = base.join(there, F.expr("tree <=> _t AND parent = _n"), "left")
    rounds = [stored(known.selectExpr("tree", "node", "_n AS jump", "1L AS n", "score AS total"), "chat-jumps")]
    # A round that brings no node to a root leaves only nodes on cycles or below them.
    while not rounds[-1].filter("jump IS NULL").isEmpty() and not rounds[-1].filter("jump IS NOT NULL").isEmpty():
        every = rounds[-1]
        for done in rounds[:-1]:
            every = every.unionAll(done.filter("jump IS NULL"))
        above = every.selectExpr("tree AS _t", "node AS _n", "jump AS _jump", "n AS _count", "total AS _total")
        longer = rounds[-1].filter("jump IS NOT NULL").join(above, F.expr("tree <=> _t AND jump = _n"))
        rounds.append(stored(longer.selectExpr("tree", "node", "_jump AS jump", "n + _count AS n", "total + _total AS total"), "chat-jumps"))
    return rounds


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return out


def branch_nodes(nodes: DataFrame, branches: int = 1) -> DataFrame:
    """Nodes of the best ``branches`` root-to-leaf paths of each tree of ``nodes`` (tree, node, parent, score).

    Returns ``tree``, ``branch``, ``leaf``, ``step`` (from 0 at the root) and ``node``; scores that are NULL count as
    0. A parent that is NULL or absent makes its node a root. A path of n nodes takes log2(n) joins
    to reach its root and as many to name its nodes. Nodes on a cycle, or below one, have no root and appear
    in no path. Node ids must be unique inside their tree and not NULL.
    """
    rounds = _jumps(nodes)
    parents = nodes.filter("parent IS NOT NULL").selectExpr("tree AS _t", "parent AS _p").distinct()
    leaves = _union([r.filter("jump IS NULL") for r in rounds]).join(parents, F.expr("tree <=> _t AND node = _p"), "left_anti")
    ranked = leaves.selectExpr("tree", "node", "n", "row_number() OVER (PARTITION BY tree ORDER BY total / n DESC, node) AS branch")
    parts = [stored(ranked.filter(F.col("branch") <= branches).selectExpr("tree", "branch", "node AS leaf", "n - 1 AS step", "node"), "chat-steps")]
    # Each distance from the leaf is one sum of powers of two, so every node of a path comes once.
    for k in range(len(rounds) - 1, -1, -1):
        up = rounds[k].filter("jump IS NOT NULL").selectExpr("tree AS _t", "node AS _n", "jump")
        higher = _union(parts).join(up, F.expr("tree <=> _t AND node = _n"))
        parts.append(stored(higher.selectExpr("tree", "branch", "leaf", f"step - {1 << k} AS step", "jump AS node"), "chat-steps"))
    return _union(parts)


def conversations(nodes: DataFrame, branches: int = 1) -> DataFrame:
    """Format the best ``branches`` paths of each tree of ``nodes`` (tree, node, parent, role, text, score).

    Branches rank by mean score along the path, then by leaf id. Returns per path ``tree``, ``branch``
    (from 1), ``leaf``, ``n_turns``, ``formatted`` and ``loss_spans``: code point ranges
    (start from 0, end exclusive) of the assistant texts inside ``formatted``. NULL role or
    text is empty; control strings inside either are escaped.
    """
    steps = branch_nodes(nodes, branches).withColumnRenamed("node", "_node")
    said = nodes.selectExpr("tree AS _t", "node AS _n", "coalesce(role, '') AS role", "coalesce(text, '') AS text")
    turns = steps.join(said, F.expr("tree <=> _t AND _node = _n")).selectExpr(
        "tree",
        "branch",
        "leaf",
        "step",
        "role = 'assistant' AS _loss",
        f"concat('{OPEN}', {escaped_role('role')}, '\\n') AS _head",
        f"{escaped('text')} AS _body",
    )
    # Where a body starts and ends: a running sum of lengths over the turns in order.
    before = "sum(length(_head) + length(_body) + {}) OVER (PARTITION BY tree, branch, leaf ORDER BY step ROWS UNBOUNDED PRECEDING)".format(len(CLOSE) + 1)
    placed = turns.withColumn("_end", F.expr(f"cast({before} - {len(CLOSE) + 1} AS int)"))
    gathered = placed.groupBy("tree", "branch", "leaf").agg(
        F.expr("array_sort(collect_list(struct(step, _loss, _head, _body, _end - length(_body) AS _start, _end))) AS _turns")
    )
    return gathered.selectExpr(
        "tree",
        "branch",
        "leaf",
        "size(_turns) AS n_turns",
        f"array_join(transform(_turns, x -> concat(x._head, x._body, '{CLOSE}', '\\n')), '') AS formatted",
        "transform(filter(_turns, x -> x._loss), x -> struct(x._start AS start, x._end AS end, x._loss AS loss)) AS loss_spans",
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Turns and loss text of formatted conversations: adds ``turns`` (role, text) and ``loss_text``."""
    return formatted.selectExpr(
        "*",
        f"transform(slice(split(formatted, '<[|]im_start[|]>'), 2, n_turns), x -> "
        f"named_struct('role', {unescaped_role(_head('x'))}, 'text', {unescaped(_body('x'))})) AS turns",
        f"array_join(transform(loss_spans, s -> {unescaped('substring(formatted, s.start + 1, s.end - s.start)')}), '') AS loss_text",
    )


def _head(part: str) -> str:
    return f"substring({part}, 1, locate('\\n', {part}) - 1)"


def _body(part: str) -> str:
    start = f"locate('\\n', {part})"
    return f"substring({part}, {start} + 1, length({part}) - {start} - {len(CLOSE) + 1})"
