"""A small row-by-row model of the stint rules, used only to check the window plans."""

from collections import defaultdict


def play_match(rows, scoring):
    """``rows`` in order: dicts with kind, code, clk, home, player_id. Returns (stints, facts, teams)."""
    state = {"active": False, "period": 0, "court": {True: set(), False: set()}, "wait": [], "open": None, "n": 0}
    done = []

    def settle():
        for home, player, entering in state["wait"]:
            (state["court"][home].add if entering else state["court"][home].discard)(player)
        state["wait"] = []

    def begin(clk):
        court = {side: frozenset(who) for side, who in state["court"].items()}
        state["open"] = {
            "id": state["n"], "period": state["period"], "start": clk, "court": court,
            "player": defaultdict(lambda: defaultdict(int)), "team": defaultdict(int),
        }
        state["n"] += 1

    def finish(clk):
        state["open"]["end"] = clk
        done.append(state["open"])

    for row in rows:
        kind = row["kind"]
        if kind == "IGNORE":
            continue
        if kind == "START":
            settle()
            state["active"] = True
            state["period"] += 1
            begin(row["clk"])
        elif kind == "END":
            if state["active"]:
                settle()
                finish(row["clk"])
            state.update(open=None, active=False, court={True: set(), False: set()})
        elif kind in ("IN", "OUT"):
            state["wait"].append((row["home"], row["player_id"], kind == "IN"))
        else:
            if state["wait"]:
                if state["open"]:
                    finish(row["clk"])
                settle()
                begin(row["clk"])
            target = state["open"] if state["active"] else (done[-1] if done else None)
            if target:
                for stat, value in scoring.get(row["code"], {}).items():
                    target["player"][row["player_id"]][stat] += value
                    target["team"][("h_" if row["home"] else "a_") + stat] += value
    stints = [(s["id"], s["period"], s["start"], s["end"]) for s in done]
    facts = [
        (s["id"], home, player, dict(s["player"][player]))
        for s in done for home in (True, False) for player in s["court"][home]
    ]
    teams = [(s["id"], dict(s["team"])) for s in done]
    return stints, facts, teams
