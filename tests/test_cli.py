"""The commands in the order a deployment uses them."""

import json

from eventlode.__main__ import main
from test_streaming import event_text, messages


def test_stream_load_check_and_read(spark, tmp_path, capsys):
    root, landing = str(tmp_path / "root"), str(tmp_path / "landing")
    texts = [event_text(i) for i in range(9)] + [event_text(99, at="2024-01-02T09:00:00Z"), "broken {"]
    messages(spark, texts).write.parquet(landing)

    def run(*args):
        code = main(["--root", root, "--buckets", "4", *args])
        lines = [json.loads(line) for line in capsys.readouterr().out.splitlines() if line.startswith("{")]
        return code, lines

    assert run("stream", "both", "--landing", landing, "--trigger", "available_now") == (0, [])
    assert run("daily", "--date", "2024-01-01") == (0, [{"facts_added": 9}])
    assert run("daily", "--date", "2024-01-01", "--facts-from", "bronze") == (0, [{"facts_added": 0}])
    code, [report] = run("quality", "--date", "2024-01-01", "--output-json", str(tmp_path / "report"))
    assert code == 0 and report["total_checks"] == 3
    assert run("quality", "--date", "2024-02-01")[0] == 1
    assert run("marts", "--as-of", "2024-03-01")[0] == 0
    assert run("kpi", "daily-active-users")[1] == [
        {"date": "2024-01-01", "daily_active_users": 3, "total_events": 9, "avg_events_per_user": "3.00"}]
    assert len(run("kpi", "revenue")[1]) == 3 and len(run("kpi", "churn-risk")[1]) == 3
    assert run("kpi", "summary")[1] == [{"total_revenue": "22.50", "high_risk_users": 3}]
