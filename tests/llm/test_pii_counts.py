"""op2_pii's counts of each kind, by table and query, against the patterns as they are written."""

import collections
import hashlib
import re

from tabmine.llm.pii_bootstrap import KINDS, luhn
from tabmine.llm.queries import op2_pii

PATTERNS = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")
TEXTS = ["a@b.cd, e@f.gh, i@j.kl", "10.0.0.1 and 10.0.0.2", "4111 1111 1111 1111", "+1 (555) 010-9999 or +44 20 7946 0000",
         "x@y.z 1.2.3.4 4111111111111111 +15550109999", "no data", "", None, "10.0.0.1 and 10.0.0.2", "300.1.2.3 a@b"]


def spans(text):
    out = []
    for k, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if (k == 0 or k == 1 and all(int(x) <= 255 for x in m[0].split("."))
                    or k == 2 and 12 <= len(digits) <= 19 and luhn(digits) or k == 3 and 9 <= len(digits) <= 15):
                out.append((m.start(), k, m.end()))
    return sorted(out)


def test_counts_are_those_of_the_kinds(spark, tmp_path):
    rows = [(i % 8, t) for i, t in enumerate(TEXTS)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    want = collections.Counter()
    for i, t in rows:
        s = spans(t or "")
        n = collections.Counter(k for _, k, _ in s)
        text = ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in s)
        want[(i, *(n[k] for k in range(4)), hashlib.sha256(text.encode()).hexdigest())] += 1
    got = op2_pii(spark, str(tmp_path)).select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256").collect()
    assert collections.Counter(map(tuple, got)) == want
