"""Hand-made payloads in the shape of the raw files."""

import datetime as dt
import json

REGISTRY = {
    "success": True,
    "extra_field": 1,
    "data": [
        {"code": "F1", "name": "Alpha", "network_id": "NEM", "network_region": "SA1", "location": {"lat": -33.1, "lng": 138.2},
         "units": [
             {"code": "U1", "fueltech_id": "wind", "status_id": "operating", "dispatch_type": "GENERATOR", "capacity_registered": 100.0},
             {"code": "U2", "fueltech_id": "battery_charging", "status_id": "operating", "dispatch_type": "LOAD", "capacity_registered": 100.0},
             {"code": None, "fueltech_id": "wind", "status_id": "retired"}]},
        {"code": "F2", "name": "Beta", "network_id": "NEM", "network_region": "VIC1", "location": None,
         "units": [{"code": "U3", "fueltech_id": "coal_brown", "status_id": "retired", "capacity_registered": 500.0}]},
        {"code": "F3", "name": "Gamma", "network_id": "WEM", "network_region": "WEM",
         "units": [{"code": "U4", "fueltech_id": "hydro", "status_id": "operating", "capacity_registered": 10.0}]},
        {"code": "F4", "name": "Delta", "network_id": "NEM", "network_region": "NSW1",
         "units": [{"code": "U5", "fueltech_id": "interconnector", "status_id": "commissioning", "capacity_registered": 5.0}]},
        {"code": "F5", "name": "Epsilon", "network_id": "NEM", "network_region": "NSW1", "units": []},
    ],
}


def series(ident, metric, fuel, unit, start, data, region="SA1"):
    return {"id": ident, "type": metric, "fuel_tech": fuel, "region": region, "units": unit,
            "history": {"start": f"{start}T00:00:00+10:00", "last": None, "interval": "1d", "data": data}}


STATS = {
    "type": "energy", "network": "nem", "region": "SA1",
    "data": [
        series("au.nem.sa1.fuel_tech.wind.energy", "energy", "wind", "GWh", "2024-01-01", [1.5, None, 0.0, 2.0]),
        series("au.nem.sa1.fuel_tech.wind.emissions", "emissions", "wind", "t", "2024-01-01", [0.0]),
        series("au.nem.sa1.demand.energy", "energy", None, "GWh", "2024-01-01", [30.0, 31.0]),
        series("au.nem.sa1.temperature_mean", "temperature_mean", None, "C", "2024-01-01", [25.0]),
        series("au.nem.sa1.fuel_tech.hydro.energy", "energy", "hydro", "GWh", "2024-01-01", None),
    ],
}


def block(metric, interval, unit_code, data, uom="MWh"):
    return {"metric": metric, "unit": uom, "interval": interval,
            "results": [{"name": f"{metric}_{unit_code}", "columns": {"unit_code": unit_code, "x": 1}, "data": data}]}


UNIT_METRICS = {
    "success": True,
    "data": [
        block("energy", "1d", "U1", [["2024-01-01T00:00:00+10:00", 120.5], ["2024-01-02T00:00:00+10:00", None],
                                     ["2024-01-03T00:00:00+10:00"], ["bad-time", 1.0], ["2024-01-04T00:00:00+10:00", "n/a"]]),
        block("energy", "5m", "U1", [["2024-01-01T00:00:00+10:00", 0.4], ["2024-01-01T23:55:00+10:00", -0.2]]),
        block("energy", "1d", "U9", [["2024-01-01T00:00:00+10:00", 7.0]]),
    ],
}

NOON = dt.datetime(2024, 6, 1, 12)


def raw(spark, *files):
    """Raw-file table from (path, payload) pairs; a payload is a dict or plain text. Times rise by a second."""
    lines = [
        (p if isinstance(p, str) else json.dumps(p), path, NOON + dt.timedelta(seconds=i)) for i, (path, p) in enumerate(files)
    ]
    return spark.createDataFrame(lines, "raw_json string, source_file string, ingested_at timestamp")


def fetched(day, family="stats/region=SA1/year=2024"):
    return f"file:/landing/{family}/fetched_at=2024-01-{day:02d}T010203Z/part-000.json"


def land(base, path, payload):
    """Write a payload below a landing folder."""
    target = base / path
    target.parent.mkdir(parents=True, exist_ok=True)
    target.write_text(payload if isinstance(payload, str) else json.dumps(payload))


def scans(df):
    """The file scans of a DataFrame's plan after it has run, with their metrics."""
    df.collect()
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if "Scan" in node.nodeName():
            found.append(node)
        elif "Adaptive" in node.nodeName():
            todo.append(node.executedPlan())
        elif "Stage" in node.nodeName() and "Codegen" not in node.nodeName():
            todo.append(node.plan())
        else:
            todo += [node.children().apply(i) for i in range(node.children().size())]
    return found
