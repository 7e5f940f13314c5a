from earlybell.operators import assess, events
from workload import q_grades  # noqa: F401
from workload.domain import Domain
from workload.registry import QUERIES

SF = "/root/testdata/sf0.001"


def counted(monkeypatch, module, name):
    calls, whole = [], getattr(module, name)
    monkeypatch.setattr(module, name, lambda *a, **kw: calls.append(1) or whole(*a, **kw))
    return calls


def test_panel_leaves_other_markets_at_the_scan(spark):
    plan = Domain(spark, SF).panel._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line and "close" not in line and "amount" in line]
    assert scans and all("Not(EqualTo(market_code,XBSE))" in line for line in scans)


def test_threshold_comparison_scans_its_panels_once(spark, monkeypatch):
    runs = counted(monkeypatch, events, "event_runs")
    assessed = counted(monkeypatch, assess, "assess_events")
    QUERIES["g10_threshold_comparison"].build(Domain(spark, SF))
    # one panel for both thresholds; formal and pressure events assessed once, for both brokers
    assert (len(runs), len(assessed)) == (1, 2)
