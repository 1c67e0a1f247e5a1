"""A small film graph in the JSON of query results, with languages, lists and an unsigned id."""

import json

from loomgraph.functions.types import Predicate
from loomgraph.plans.catalog import Schema

SCHEMA = Schema.of(
    [
        Predicate("graph.type", "string"), Predicate("name", "string"), Predicate("title", "string", True), Predicate("release_date", "datetime"),
        Predicate("revenue", "float"), Predicate("running_time", "int"), Predicate("starring", "uid"), Predicate("director", "uid"),
    ]
)

#: The sample data whose row counts and ranks are known.
PEOPLE = {1: "Luke Skywalker", 2: "Princess Leia", 3: "Han Solo", 4: "George Lucas", 5: "Irvin Kernshner", 6: "Richard Marquand"}
FILMS = {
    7: ("Star Wars: Episode IV - A New Hope", ["en", "hu", "be", "cs", "br", "de"], "1977-05-25T00:00:00Z", "775000000", 121, 4),
    8: ("Star Wars: Episode V - The Empire Strikes Back", ["en", "ka", "ko", "iw", "de"], "1980-05-21T00:00:00+02:00", "534000000", 124, 5),
    9: ("Star Wars: Episode VI - Return of the Jedi", ["en", "zh", "th", "fa", "ar", "de"], "1983-05-25T00:00:00Z", "572000000", 131, 6),
}


def results() -> str:
    nodes = [{"uid": hex(k), "graph.type": "Person", "name": n, "age@en": "dropped"} for k, n in PEOPLE.items()]
    for k, (title, langs, date, revenue, minutes, director) in FILMS.items():
        film = {"uid": hex(k), "graph.type": "Film", "title": title, "release_date": date, "revenue": revenue, "running_time": minutes}
        film |= {f"title@{x}": f"{title} ({x})" for x in langs}
        film |= {"starring": [{"uid": hex(a)} for a in (1, 2, 3)], "director": [{"uid": hex(director)}]}
        nodes.append(film)
    trek = {"uid": "0xa7eb7890d6db0f1f", "graph.type": "Film", "title@en": "Star Trek: The Motion Picture", "release_date": "1979-12-07T00:00:00Z"}
    nodes.append(trek | {"revenue": "139000000", "running_time": 132})
    return json.dumps({"result": nodes})


TREK = -6346846686373277921
