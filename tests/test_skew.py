"""Hot-key guard: one fund with a third of all rows must not load one reducer."""

import os
import re
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_volatility_reducers_stay_balanced_with_a_hot_fund():
    out = subprocess.run([sys.executable, os.path.join(ROOT, "tools", "skew_check.py"), "/root/testdata/sf0.01"],
                         cwd=ROOT, capture_output=True, text=True, timeout=900)
    assert out.returncode == 0, out.stderr[-2000:]
    hot = re.search(r"hot fund rows \d+ \((\d+)%\)", out.stdout)
    assert hot and int(hot.group(1)) >= 30
    shares = [(float(p), int(n)) for p, n in re.findall(r"largest task \d+ \(([\d.]+)%\) over (\d+) tasks", out.stdout)]
    assert len(shares) == 2                      # two shuffles: (fund, week) then fund
    for pct, tasks in shares:
        assert pct <= 3 * 100 / tasks, out.stdout  # at most three times an even share
