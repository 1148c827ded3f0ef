"""Functions sent to executors must not need this package there."""

from __future__ import annotations

import subprocess
import sys

from pyspark import cloudpickle

from townvoice.operators.fold import fold_ranges
from townvoice.sources import pages as G
from townvoice.sources.markup import parse


def test_functions_load_without_the_package(tmp_path):
    picks = [*G.LISTINGS.values(), *G.DETAILS.values(), G.generic]
    (tmp_path / "functions").write_bytes(cloudpickle.dumps((fold_ranges(100, False), parse, picks)))
    script = (
        "import pickle, sys; fold, parse, picks = pickle.load(open('functions', 'rb'))\n"
        "pages = [pick(parse('<title>a</title><div class=x>b</div>')) for pick in picks]\n"
        "pages = [page if isinstance(page, dict) else list(page) for page in pages]\n"
        "assert list(fold(iter([]))) == [] and pages[-1]['title'] == 'a'\n"
        "assert not any(name.startswith('townvoice') for name in sys.modules)\n"
    )
    subprocess.run([sys.executable, "-I", "-c", script], cwd=tmp_path, check=True, timeout=120)
