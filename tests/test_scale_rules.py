"""Static checks of the library source against the scale rules: no local
checkpoints, no cross joins, no window without partitioning, no funnelling
through one task or the driver except at reviewed, bounded call sites."""

import io
import pathlib
import re
import tokenize

import pytest

SRC = pathlib.Path(__file__).resolve().parent.parent / "questa"
FILES = sorted(p for p in SRC.rglob("*.py") if "llm" not in p.relative_to(SRC).parts)

# every driver collect, with the reason its size is bounded
BOUNDED_COLLECTS = {
    ("operators/knn.py", "_halos(ends"): "at most 3k rows per partition and target, and two",
    ("operators/knn_nd.py", "limit(count)"): "at most MAX_PIVOTS points",
    ("operators/knn_nd.py", "groupBy(\"cell\")"): "one row per pivot's cell",
    ("operators/knn_nd.py", "groupBy(\"bucket\")"): "one row per cell or shell, at most MAX_BUCKETS and a row a pivot",
    ("operators/order.py", "hist = sorted"): "at most 65,536 prefix buckets",
    ("operators/order.py", "groupBy(F.substring(\"_h\", 1, plen)"): "at most 65,536 prefix buckets",
    ("sources/split_csv.py", "mapInArrow(_measure"): "one row per range of a file, as in a scan's list of splits",
    ("operators/order.py", "groupBy(_PID)"): "one row per range partition",
    ("operators/order.py", ".offset(k - 1).limit(1)"): "one row",
    ("operators/order.py", "rest.groupBy(pcol"): "at most 65,536 prefix buckets",
    ("operators/order.py", ".count().collect()), key=lambda"): "at most 65,536 prefix buckets",
    ("operators/cost.py", "dim.limit(limit + 1)"): "at most limit + 1 rows",
    ("operators/cost.py", "count\") > 1).limit(1)"): "at most one repeated key",
    ("operators/joins.py", ".limit(1).collect()"): "at most one duplicate key",
    ("__main__.py", "rows = report.collect()"): "a metrics table of a few rows",
}


def _lines(path):
    return path.read_text().splitlines()


def _code_lines(path):
    """Source lines with comments and string literals blanked out."""
    lines = path.read_text().splitlines(keepends=True)
    out = [list(line) for line in lines]
    for tok in tokenize.generate_tokens(io.StringIO("".join(lines)).readline):
        if tok.type in (tokenize.COMMENT, tokenize.STRING):
            (r0, c0), (r1, c1) = tok.start, tok.end
            for r in range(r0, r1 + 1):
                row = out[r - 1]
                a = c0 if r == r0 else 0
                b = c1 if r == r1 else len(row)
                for c in range(a, min(b, len(row))):
                    if row[c] != "\n":
                        row[c] = " "
    return ["".join(r) for r in out]


@pytest.mark.parametrize("pattern", [r"localCheckpoint", r"crossJoin", r"coalesce\(1\)",
                                     r"\.toPandas\(", r"\.rdd\b", r"Window\.orderBy"])
def test_forbidden_patterns_absent(pattern):
    hits = [f"{p.relative_to(SRC)}:{i + 1}" for p in FILES
            for i, line in enumerate(_code_lines(p)) if re.search(pattern, line)]
    assert hits == [], hits


def test_every_collect_is_reviewed_and_bounded():
    found = []
    for p in FILES:
        text = p.read_text()
        rel = str(p.relative_to(SRC))
        for m in re.finditer(r"\.collect\(\)", text):
            line = text[text.rfind("\n", 0, m.start()) + 1:text.find("\n", m.end())]
            prev = text[max(0, m.start() - 200):m.start()]
            ok = any(rel == f and (frag in line or frag in prev) for (f, frag) in BOUNDED_COLLECTS)
            found.append((rel, line.strip(), ok))
    unreviewed = [(f, l) for f, l, ok in found if not ok]
    assert unreviewed == [], unreviewed


def test_row_limits_only_bound_checks():
    """``limit(n)`` appears only as a size probe (n = bound + 1) or to take
    one row, never to cut a result."""
    for p in FILES:
        for i, line in enumerate(_lines(p)):
            for m in re.finditer(r"\.limit\(([^)]*)\)", line):
                assert m.group(1) in ("1", "limit + 1", "max_rows + 1", "count"), f"{p}:{i + 1}: {line}"
