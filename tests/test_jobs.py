"""The command-line jobs end to end, in their own process (as a scheduler would run them)."""

import json
import os
import subprocess
import sys
import tempfile

from test_end_to_end import FX_LINES, _indicator_pages, _mobile_page

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_jobs_run_all_steps():
    d = tempfile.mkdtemp()
    with open(os.path.join(d, "fx.csv"), "w") as f:
        f.write(FX_LINES)
    os.makedirs(os.path.join(d, "wb"))
    _indicator_pages(os.path.join(d, "wb"))
    with open(os.path.join(d, "mobile.html"), "w") as f:
        f.write(_mobile_page())
    with open(os.path.join(d, "sheet.csv"), "w") as f:
        f.write("Measure,Geo_view,Geo_name,Attribute,Unit,Metric,01/09/2016,01/12/2016\n"
                "Accounts,Region,Sub-Saharan Africa ,Registered,Accounts,MM,100, \n")
    out = os.path.join(d, "site", "latest.json")
    os.makedirs(os.path.dirname(out))
    env = dict(os.environ, PYTHONPATH=REPO)
    code = ("import sys; from quarry.session import get_spark; "
            f"get_spark('local[4]', 4, extra={{'spark.sql.warehouse.dir': {d + '/wh'!r}}}); "
            "from quarry.jobs import main; "
            f"sys.exit(main(['all', '--fx', {d + '/fx.csv'!r}, '--indicator', {d + '/wb'!r}, "
            f"'--mobile', {d + '/mobile.html'!r}, '--metric', {d + '/sheet.csv'!r}, '--as-of', '2026-07-15', "
            f"'--parallel', '2', '--out', {out!r}]))")
    r = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=600, env=env, cwd=d)
    assert r.returncode == 0, r.stdout[-2000:] + r.stderr[-3000:]
    assert "cbk_fx_csv: received 11, inserted 10, skipped 1" in r.stdout
    assert "data tests: 32 of 32 passed" in r.stdout
    with open(out) as f:
        assert json.load(f)["fx"]["kes_per_usd"]["as_of"] == "2016-10-13"


def test_jobs_stream_step_lands_new_files_once():
    d = tempfile.mkdtemp()
    os.makedirs(os.path.join(d, "in"))
    with open(os.path.join(d, "in", "a.csv"), "w") as f:
        f.write(FX_LINES)
    env = dict(os.environ, PYTHONPATH=REPO)
    code = ("import sys; from quarry.session import get_spark; "
            f"get_spark('local[4]', 4, extra={{'spark.sql.warehouse.dir': {d + '/wh'!r}}}); "
            "from quarry.jobs import main; "
            f"args = ['stream', '--fx-dir', {d + '/in'!r}, '--checkpoint', {d + '/ck'!r}]; "
            "main(args); main(args)")
    r = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=600, env=env, cwd=d)
    assert r.returncode == 0, r.stderr[-3000:]
    assert r.stdout.count("bronze.cbk_fx_rates: 10 rows") == 2
