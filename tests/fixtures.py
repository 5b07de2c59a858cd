"""Hand-made match documents (FIXTURES.md §1-§2); values are invented."""

import copy
import json
import os

HAPPY = {
    "info": {
        "city": "Leeds", "gender": "male", "match_type": "ODM", "venue": "North Ground",
        "dates": ["2017-02-17", "2017-02-18"], "umpires": ["U One", "U Two"], "teams": ["Reds", "Blues"],
        "player_of_match": ["A Bat"], "toss": {"decision": "bat", "winner": "Reds"},
        "outcome": {"by": {"innings": 1, "runs": 45}, "winner": "Reds"},
        "registry": {"people": {"A Bat": "p1", "B Bowl": "p2", "C Run": "p3"}},
    },
    "innings": [{"1st innings": {"team": "Reds", "deliveries": [
        {"0.1": {"batsman": "A Bat", "bowler": "B Bowl", "non_striker": "C Run",
                 "runs": {"batsman": 4, "extras": 0, "total": 4}}},
        {"0.2": {"batsman": "A Bat", "bowler": "B Bowl", "non_striker": "C Run",
                 "runs": {"batsman": 0, "extras": 1, "total": 1},
                 "wicket": {"kind": "bowled", "player_out": "A Bat"}}},
    ]}}],
}


def variant(fn):
    d = copy.deepcopy(HAPPY)
    fn(d)
    return d


def _ball(d):
    return d["innings"][0]["1st innings"]["deliveries"][0]["0.1"]


def _set(path_fn):
    return path_fn


EDGE = {
    "2001": "{not json",
    "2002": "",
    "2003": variant(lambda d: d.pop("innings")),
    "2004": variant(lambda d: _ball(d).pop("runs")),
    "2005": variant(lambda d: _ball(d).__setitem__("wicket", [{"kind": "bowled"}])),
    "2006": variant(lambda d: d["info"].__setitem__("teams", ["Reds"])),
    "2007": variant(lambda d: d["innings"][0]["1st innings"].pop("team")),
    "2008": variant(lambda d: _ball(d).__setitem__("declared", "Yes")),
    "2009": variant(lambda d: d["info"]["outcome"].clear()),
    "2010": variant(lambda d: (d["info"].__setitem__("umpires", ["Solo"]), d["info"].__setitem__("dates", ["2017-02-17"]))),
    "2011": variant(lambda d: (d["info"].pop("umpires"), d["info"].pop("city"), d["info"].pop("toss"))),
    "2012": variant(lambda d: d["info"].__setitem__("dates", ["17/02/2017"])),
    "2013": variant(lambda d: d["info"]["registry"]["people"].__setitem__("A Bat", {"id": "p1"})),
    "2014": variant(lambda d: d["info"].pop("registry")),
    "2015": {"meta": {"x": 1}},
    "2016": variant(lambda d: d["innings"][0]["1st innings"]["deliveries"].extend(
        [{"0.10": {"batsman": "A Bat", "bowler": "B Bowl", "non_striker": "C Run",
                   "runs": {"batsman": 6, "extras": 0, "total": 6}}},
         {"19.6": {"batsman": "A Bat", "bowler": "B Bowl", "non_striker": "C Run",
                   "runs": {"batsman": 5, "extras": 0, "total": 5}}}])),
    "2017": variant(lambda d: d["info"].__setitem__("umpires", "AB")),
    "2018": "[1, 2, 3]",
}


def write_docs(folder, docs, ext=".json"):
    os.makedirs(folder, exist_ok=True)
    for mid, doc in docs.items():
        with open(os.path.join(folder, mid + ext), "w") as f:
            f.write(doc if isinstance(doc, str) else json.dumps(doc))
    return folder
