"""What several test modules share besides fixtures; ``conftest`` is no name to import from, as each folder has its own."""

import os

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def rows(df, *order):
    """Rows as tuples, sorted with NULLs last."""
    out = [tuple(r) for r in df.collect()]
    return sorted(out, key=lambda t: [(v is None, str(type(v)), v if v is not None else 0) for v in t])
