"""The JSON texts of ``samples.match_documents``: written by columns inside the tasks, a match per order."""

from __future__ import annotations

from collections.abc import Callable

from medalstar import schemas

SCHEMA = "doc_id bigint, value string"

# Matches of one Arrow batch: some 8 MB of text.
_PER_BATCH = 1000
# Beyond this key the products below could leave 64 bits, which fails as it would in SQL.
_LARGEST_KEY = 2**63 // 1000


def writer() -> Callable:
    """A function for ``mapInArrow`` over (doc_id bigint, start bigint, epoch milliseconds); keys of value NULL are left out.

    Values repeat with the key, so the text of each is made once per task and looked up by number. Every helper is a
    closure, as workers need not have this package.
    """
    required, optional, objectives = (
        {name: kind.simpleString() for name, kind in fields.items()}
        for fields in (schemas.PARTICIPANT_REQUIRED, schemas.PARTICIPANT_OPTIONAL, dict.fromkeys(schemas.OBJECTIVE_NAMES, schemas.LONG))
    )
    per_batch, largest_key = _PER_BATCH, _LARGEST_KEY

    def run(batches):
        import json

        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        def rest(number: int, modulus: int) -> int:
            """Remainder with the sign of the number, as in SQL."""
            return number % modulus if number >= 0 else -(-number % modulus)

        def text(value) -> str:
            return json.dumps(value, separators=(",", ":"))

        def perks(k: int, i: int) -> str:
            """0 to 2 styles, with 0 to 4 picks each."""
            styles = [
                {"style": 8000 + 100 * s + i,
                 "selections": [{"perk": 8000 + 10 * p + s + rest(k, 7)} for p in range(4)][:max(0, rest(k + i * (s + 1), 5))]}
                for s in (0, 1)
            ][:max(0, rest(k + i, 3))]
            shards = {"defense": rest(k + i, 3), "flex": rest(k + 2 * i, 4), "offense": rest(k + 3 * i, 5)}
            return text({"styles": styles, **({"statPerks": shards} if rest(k, 4) else {})})

        def objective(k: int, team: int) -> str:
            return text({
                name: {
                    **({"kills": rest(k + team + place, 12)} if rest(k + place, 5) else {}),
                    **({"first": rest(k + team + place, 2) == 0} if rest(k + place, 7) else {}),
                }
                for place, name in enumerate(objectives) if rest(k + place, 6)
            })

        def bans(k: int, team: int) -> str:
            return text([
                {"championId": rest(k * b + team, 160)} if rest(k + b, 8) else {} for b in range(1, 7)
            ][:max(0, rest(k + team, 7))])

        made: dict = {}

        def periodic(make, period: int, k, n):
            """``make(k, n)`` for whole columns; it repeats with ``period`` among keys of one sign, away from zero."""
            near = np.where(np.abs(k) < period, k, np.fmod(k, period) + np.sign(k) * period)
            codes, places = np.unique(near * 16 + n, return_inverse=True)
            known = made.setdefault(make.__name__, {})
            for code in codes.tolist():
                if code not in known:
                    known[code] = make(code >> 4, code & 15)
            return pa.array([known[code] for code in codes.tolist()], pa.string()).take(pa.array(places))

        def numbered(shape: str, values, modulus: int, present=None):
            """``shape % value`` for remainders; nothing where not ``present``."""
            if shape not in made:
                made[shape] = pa.array([shape % v for v in range(1 - modulus, modulus)] + [""], pa.string())
            places = values + (modulus - 1)
            return made[shape].take(pa.array(places if present is None else np.where(present, places, 2 * modulus - 1)))

        def chosen(condition, yes: str, no: str):
            return pa.array([no, yes], pa.string()).take(pa.array(condition.astype("int64")))

        def joined(*parts):
            return pc.binary_join_element_wise(*parts, "")

        def participants(k):
            """The participants of every match, joined by commas."""
            counts = np.maximum(np.fmod(k, 10) + 1, 0)
            ends = np.cumsum(counts)
            i = np.arange(counts.sum()) - np.repeat(ends - counts, counts) + 1
            k = np.repeat(k, counts)
            parts: list = []

            def number(a: int, b: int, modulus: int):
                return np.fmod(k * a + i * b, modulus)

            for place, (name, kind) in enumerate(required.items(), start=1):
                key = f'{"," if parts else "{"}"{name}":'
                if name == "puuid":
                    parts.append(numbered(key + '"P_%d"', number(1, 7, 100), 100))
                elif name == "participantId":
                    parts.append(numbered(key + "%d", i, 11))
                elif name == "teamId":
                    parts.append(numbered(key + "%d", np.where(i <= 5, 100, np.where(np.fmod(k, 9) == 0, 300, 200)), 301))
                elif kind == "boolean":
                    parts.append(chosen(number(place, 3, 2) == 0, key + "true", key + "false"))
                elif kind == "string":
                    parts.append(numbered(f'{key}"{name}_%d"', number(place, 1, 20), 20))
                else:
                    parts.append(numbered(key + "%d", number(place, 5, 500 + place), 500 + place))
            for place, (name, kind) in enumerate(optional.items(), start=2):
                shape = f',"{name}":' + ('"n%d"' if kind == "string" else "%d")
                parts.append(numbered(shape, number(place, 1, 90), 90, number(1, place, 4) != 0))
            lines = joined(*parts, ',"perks":', periodic(perks, 420, k, i), "}")
            offsets = pa.array(np.concatenate([[0], ends]).astype("int32"))
            return pc.binary_join(pa.ListArray.from_arrays(offsets, lines), ",")

        def team(k, number: int, team_id):
            won = chosen(np.fmod(k + number, 2) == 0, "true", "false")
            column = np.full(len(k), number)
            return joined('{"teamId":', team_id, ',"win":', won, ',"objectives":', periodic(objective, 420, k, column),
                          ',"bans":', periodic(bans, 1120, k, column), "}")

        def documents(batch):
            ids, start = batch.column(0), batch.column(1)
            k = ids.fill_null(0).to_numpy(zero_copy_only=False)
            if len(k) and max(int(k.max()), -int(k.min())) > largest_key:
                raise OverflowError("order key too large for the documents")

            def timed(name: str, shift):
                moment = pc.add_checked(start, pa.array(shift))
                return pc.fill_null(joined(f',"{name}":', moment.cast(pa.string())), "")

            minutes = np.fmod(k, 40)
            none = np.zeros(len(k), "int64")
            return joined(
                '{"metadata":{"matchId":"J_', ids.cast(pa.string()), '"},"info":{"platformId":"VN2"',
                numbered(',"queueId":%d', np.fmod(k, 60) + 400, 460),
                chosen(np.fmod(k, 6) == 2, ',"gameMode":"ARAM"', ',"gameMode":"CLASSIC"'),
                numbered(',"gameVersion":"14.%d.1"', np.fmod(k, 24), 24),
                timed("gameCreation", none - 5000), timed("gameStartTimestamp", none), timed("gameEndTimestamp", minutes * 60000),
                numbered(',"gameDuration":%d', minutes * 60, 2400, np.fmod(k, 8) != 0),
                ',"participants":[', participants(k), '],"teams":[', team(k, 1, "100"), ",",
                team(k, 2, chosen(np.fmod(k, 9) == 0, "300", "200")), "]}}")

        for batch in batches:
            for at in range(0, batch.num_rows, per_batch):
                part = batch.slice(at, per_batch)
                yield pa.record_batch([part.column(0), documents(part)], ["doc_id", "value"])

    return run
