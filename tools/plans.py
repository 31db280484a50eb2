"""Write PLANS.md: the physical plans of the pipeline stages (stored mode)."""

import os
import re
import sys
import tempfile

sys.path.insert(0, ".")
from ledgerlake.sources.fixture import adapter_config  # noqa: E402
from ledgerlake.operators import checks as K  # noqa: E402
from ledgerlake.operators import insights as I  # noqa: E402
from ledgerlake.operators import marts as M  # noqa: E402
from ledgerlake.operators import staging as G  # noqa: E402
from ledgerlake.plans.pipeline import Spend  # noqa: E402
from ledgerlake.session import local_session  # noqa: E402
from ledgerlake.sources.tables import TableStore, run_folder, use_root  # noqa: E402

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
spark = local_session()
use_root(spark, tempfile.mkdtemp(prefix="ledgerlake-plans-"))
s = Spend(spark, sf, adapter_config(), TableStore(spark, run_folder(spark)))
s.fact, s.curated, s.mss, s.ct, s.pa, s.ps
stages = [
    ("Staging projection (over the stored source)", G.stg_transform(s.src, s.cfg)),
    ("Dimension pairs (all four dimensions, one pass)", G.dimension_pairs(s.stg)),
    ("Fact build", G.fact_spending(s.stg, s.dims, s.cfg)),
    ("Monthly summary mart", M.monthly_summary(s.latest, s.cfg)),
    ("Category trends mart", M.category_trends(s.latest, s.cfg)),
    ("Person analytics mart", M.person_analytics(s.latest, s.cfg)),
    ("Payment summary mart", M.payment_summary(s.latest, s.cfg)),
    ("Budget alerts view", I.budget_alerts(s.pa, s.mss)),
    ("Row-level source checks (one aggregate scan + bounded sample pass)", K.row_level_checks(s.src, s.cfg)),
]
root = s.store.root
out = ["# Physical plans", "",
       f"Generated by `tools/plans.py` at {os.path.basename(sf)} in stored mode (each stage reads the stored",
       "tables of the previous one). Tree part of `explain(\"formatted\")`; table paths shortened.", ""]
for title, df in stages:
    plan = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    tree = plan.split("\n\n")[0].replace(root, "<store>")
    tree = re.sub(r"file:[^ ,\]]*", "<path>", tree)
    out += [f"## {title}", "", "```", tree.strip(), "```", ""]
open("PLANS.md", "w").write("\n".join(out))
print("wrote PLANS.md")
