"""Hand-written input rows (FIXTURES.md §3) and their expected results."""

import datetime as dt

from trialscope import schemas

D = dt.date
ASOF = D(2024, 11, 30)
TITLE = "t" * 200
X60 = "x" * 60


def _study(nct, stype, phase, status, start, primary, completion, types, enrollment=1234):
    return (nct, stype, phase, status, TITLE, enrollment, "ACTUAL", D(2024, 1, 1),
            start, types, primary, types, completion, types)


STUDIES = [
    _study("N01", "INTERVENTIONAL", "PHASE1/PHASE2", "RECRUITING",
           D(2024, 11, 30), D(2025, 2, 28), D(2025, 2, 27), None),
    _study("N02", "INTERVENTIONAL", None, "NOT_YET_RECRUITING",
           D(2025, 2, 27), None, None, "ACTUAL", enrollment=None),
    _study("N03", "OBSERVATIONAL", "PHASE1", "RECRUITING", D(2025, 1, 1), None, None, None),
    _study("N04", "INTERVENTIONAL", "phase1", None, D(2025, 1, 1), None, None, None),
    _study("N05", "INTERVENTIONAL", "PHASE4", "COMPLETED", D(2025, 1, 1), None, None, None),
    _study("N06", "INTERVENTIONAL", "NA", "ACTIVE_NOT_RECRUITING", None, None, None, None),
    _study("N07", "INTERVENTIONAL", "EARLY_PHASE_1", "ENROLLING_BY_INVITATION",
           D(2025, 1, 15), D(2025, 1, 15), D(2025, 1, 15), "ESTIMATED"),
    _study("N08", "INTERVENTIONAL", "PHASE_4", "WITHHELD", None, None, None, None),
]

SPONSORS = [
    ("N01", "Beta", "lead"), ("N01", "Acme", "lead"), ("N01", None, "lead"),
    ("N01", "Aaa", "collaborator"), ("N02", "Zed", "collaborator"), ("N07", " Acme ", "lead"),
]

INTERVENTIONS = [
    ("N01", "DRUG", X60 + "1"), ("N01", "DEVICE", X60 + "2"), ("N01", "DRUG", "y"),
    ("N01", None, None), ("N02", None, None),
]

CONDITIONS = [("N01", "b"), ("N01", "a"), ("N01", "a")]

# (event_date, event_type, event_date_type, nct_id, phase_std, lead_sponsor,
#  intervention_types, interventions, conditions), in final order
EVENTS = [
    (D(2024, 11, 30), "START", "ESTIMATED", "N01", "Phase 1/2", "Acme", "DEVICE, DRUG",
     X60 + " · y", "a, b"),
    (D(2025, 1, 15), "START", "ESTIMATED", "N07", "Early Phase 1", " Acme ", None, None, None),
    (D(2025, 1, 15), "PRIMARY_COMPLETION", "ESTIMATED", "N07", "Early Phase 1", " Acme ",
     None, None, None),
    (D(2025, 1, 15), "COMPLETION", "ESTIMATED", "N07", "Early Phase 1", " Acme ", None, None, None),
    (D(2025, 2, 27), "START", "ACTUAL", "N02", "Unknown", None, None, None, None),
    (D(2025, 2, 27), "COMPLETION", "ESTIMATED", "N01", "Phase 1/2", "Acme", "DEVICE, DRUG",
     X60 + " · y", "a, b"),
]

PHASE_STATUS = {
    ("Early Phase 1", "ENROLLING_BY_INVITATION"): 1,
    ("Not Applicable", "ACTIVE_NOT_RECRUITING"): 1,
    ("Phase 1/2", "RECRUITING"): 1,
    ("Phase 4", "COMPLETED"): 1,
    ("Phase 4", "WITHHELD"): 1,
    ("Unknown", "NOT_YET_RECRUITING"): 1,
    ("Unknown", "UNKNOWN"): 1,
}


def tables(spark):
    return {
        "studies": spark.createDataFrame(STUDIES, schemas.STUDIES),
        "sponsors": spark.createDataFrame(SPONSORS, schemas.SPONSORS),
        "interventions": spark.createDataFrame(INTERVENTIONS, schemas.INTERVENTIONS),
        "conditions": spark.createDataFrame(CONDITIONS, schemas.CONDITIONS),
    }
