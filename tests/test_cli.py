import os
import subprocess
import sys

from tests.test_pipeline import _land

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _run(*args):
    env = dict(os.environ, PYTHONPATH=REPO)
    out = subprocess.run([sys.executable, "-m", "rinkstat", *args], cwd=REPO, env=env,
                         capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    return out.stdout


def test_cli_runs_the_daily_chain(spark, tmp_path):
    land, raw, dwh = str(tmp_path / "landing"), str(tmp_path / "raw"), str(tmp_path / "dwh")
    _land(land, 1)
    common = ["--landing", land, "--raw", raw, "--dwh", dwh, "--ds", "2024-01-01"]
    part = ["--games-partition", "block", "CAST(gameId DIV 2 AS INT)"]
    _run("teams", *common)
    out = _run("players", *common, *part)
    assert "roster" in out
    _run("aggregates", *common, *part)
    _run("schedule", *common)
    assert spark.read.parquet(f"{dwh}/skaters_agg").count() == 2
    assert spark.read.parquet(f"{dwh}/players_games_datamart").count() == 3
    assert spark.read.parquet(f"{dwh}/shedule").count() == 2
