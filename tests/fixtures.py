"""Small made-up rows in the shapes the analyses read."""

import random

from statlab.catalog import KEEPER_ONLY, LABELS, column_name

TEAMS = ["Ashford Town", "Brockley", "Castle Rovers", "Dunmere", "Eastvale Utd"]
NULLABLE = [column_name(x) for x in KEEPER_ONLY]


def players(n=120, seed=7):
    """Rows keyed by column: keepers alone have keeper metrics, and two metrics are the same."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        keeper = i % 12 == 0
        attack = 3.0 if i % 4 == 1 else 1.0
        row = {
            "player": f"Player {i:03d}", "team": TEAMS[i % len(TEAMS)], "nation": ["ENG", "FRA", "BRA"][i % 3],
            "position": "GK" if keeper else ["DF", "MF", "FW,MF", "MF,FW", "FW"][i % 5],
        }
        for label in LABELS:
            m = column_name(label)
            if label == "Minutes":
                row[m] = float(rng.randint(60, 3000))
            elif m in NULLABLE:
                row[m] = round(rng.uniform(0, 100), 2) if keeper else None
            elif label.endswith("%") or "per" in label or "90" in label:
                row[m] = round(rng.uniform(0, 50) * attack, 2)
            else:
                row[m] = float(round(rng.expovariate(0.05) * attack))
        row["rec_prgr"] = row["prgr"]
        rows.append(row)
    return rows
