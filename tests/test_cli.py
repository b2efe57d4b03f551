"""The command line runs the batch job on a CSV catalogue (subprocess)."""

import json
import os
import subprocess
import sys
import tempfile

from conftest import ROOT, SF_SMALL


def test_cli_batch_on_csv(spark):
    from quakescope.session import scratch_path
    from quakescope.sources import sinks
    from quakescope.sources.fixture import quakes

    src = scratch_path(spark, "cli-src")
    sinks.write_csv(quakes(spark, SF_SMALL), src)
    out = tempfile.mkdtemp(prefix="qs-cli-")
    res = subprocess.run([sys.executable, "-m", "quakescope", "--master", "local[2]", "batch", src, out],
                         cwd=ROOT, capture_output=True, text=True, timeout=600)
    assert res.returncode == 0, res.stderr[-2000:]
    metrics = json.loads(res.stdout.strip().splitlines()[-1])
    assert (metrics["raw_records"], metrics["clean_records"]) == (1028, 578)
    assert os.path.isdir(os.path.join(out, "analytics_results.json"))


def test_cli_ingest_then_stream(spark):
    from quakescope.session import scratch_path
    from quakescope.sources import sinks
    from quakescope.sources.fixture import quakes

    src = scratch_path(spark, "cli-src2")
    sinks.write_csv(quakes(spark, SF_SMALL), src)
    feed, out, ck = (tempfile.mkdtemp(prefix="qs-cli-") + "/" + n for n in ("feed", "out", "ck"))
    run = [sys.executable, "-m", "quakescope", "--master", "local[2]"]
    res = subprocess.run(run + ["ingest", src, "--out", feed], cwd=ROOT, capture_output=True,
                         text=True, timeout=600)
    assert res.returncode == 0, res.stderr[-2000:]
    assert json.loads(res.stdout.strip().splitlines()[-1])["success_count"] == 1028
    res = subprocess.run(run + ["stream", out, ck, "--source", feed], cwd=ROOT, capture_output=True,
                         text=True, timeout=600)
    assert res.returncode == 0, res.stderr[-2000:]
    assert spark.read.parquet(out).count() > 0
