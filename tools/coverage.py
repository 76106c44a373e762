"""Print which registered plans exercise each SURVEY §2 operator id."""
import os
import re
import sys
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from gapseries.plans import registry  # noqa: E402

ids = registry.operator_ids()
sql = registry.sql()
m = defaultdict(list)
for name, s in ids.items():
    for i in s.split():
        m[i].append(name + ("" if name in sql else " (rows only)"))


def order(k):
    num = re.search(r"\d+", k)
    return (re.match(r"[A-Z]+", k).group(), int(num.group()) if num else 0)


for k in sorted(m, key=order):
    print(f"| {k} | {', '.join(m[k])} |")
print(len(ids), "plans,", len(sql), "with an SQL twin")
