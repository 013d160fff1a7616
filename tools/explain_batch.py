"""Physical plan of one pipeline batch's merge (after earlier batches), for docs/PLANS.md.

Three batches with growing invoice ids are loaded, then the fourth batch's
increment -> enrichment -> insert-only merge plan is printed, built exactly as
the runner builds it (batch-folder increment, pruned target probe).
"""

from __future__ import annotations

import sys
from datetime import datetime, timedelta, timezone

sys.path.insert(0, ".")
from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import tidemark.plans.runner as R  # noqa: E402
from tidemark.operators.enrich import enrich  # noqa: E402
from tidemark.operators.increment import increment  # noqa: E402
from tidemark.operators.ledger import read_ledger, summarise_ledger  # noqa: E402
from tidemark.operators.merge import merge_insert, source_key_size  # noqa: E402
from tidemark.operators.quality import RowCountBetween  # noqa: E402
from tidemark.operators.rollup import rollup_dimension  # noqa: E402
from tidemark.session import scratch_path  # noqa: E402
from tidemark.sources.fixtures import county_rows  # noqa: E402
from tidemark.sources.synth import synth_transactions  # noqa: E402

sys.path.insert(0, "tools")
from explain_plans import tree  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").config("spark.sql.shuffle.partitions", "8")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    root = scratch_path(spark, "explain-batch")
    cfg = R.PipelineConfig(landing=f"{root}/landing", root=f"{root}/lake", max_files=1,
                           suite=(RowCountBetween(1, None),), min_records=1, fact_key="state")
    R.bootstrap(spark, cfg, rollup_dimension(county_rows(spark, sf), key="State"))
    t0 = datetime(2024, 1, 1, tzinfo=timezone.utc)
    for i in range(4):
        df = synth_transactions(spark.range(i * 1000, i * 1000 + 100), "id").coalesce(1)
        df.withColumn("invoiceid", F.monotonically_increasing_id() + F.lit(i * 1000)) \
            .write.parquet(f"{cfg.landing}/f{i}")
    for i in range(3):
        R.run_batch(spark, cfg, t0 + timedelta(hours=i))
    # the fourth batch, planned as the runner plans it
    ledger = read_ledger(spark, cfg.ledger_path)
    summary = summarise_ledger(ledger)
    dim, dim_schema = R._dimension(spark, cfg)
    enr_t, raw_t = cfg.enriched_table(dim_schema), cfg.raw_table()
    stamp = t0 + timedelta(hours=3)
    batch_id = R.batch_id_for(stamp)
    paths = [r["path"] for r in R.list_files(spark, f"{cfg.landing}/f3").select("path").collect()]
    landing_df = R.read_landing(spark, paths)
    R.append(raw_t, R.to_raw(landing_df, stamp), batch_id, cluster="local")
    new = increment(R.read_batch(spark, raw_t, batch_id), summary.watermark_us, "processed_date")
    enriched_new = enrich(new.select(*raw_t.columns), dim, cfg.fact_key, cfg.dim_key)
    size = source_key_size(enriched_new, cfg.key)
    target = R.probe_target(spark, enr_t, ledger, batch_id, int(size.key_min), int(size.key_max),
                            index=cfg.key_index_path, keys=new.select(cfg.key))
    print(f"probed folders: {sorted(set(f.split('batch_id=')[1].split('/')[0] for f in target.inputFiles()))}")
    print(tree(merge_insert(target, enriched_new, cfg.key, size=size)))
    spark.stop()


if __name__ == "__main__":
    main()
