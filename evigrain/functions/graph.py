"""Evidence graphs and claims as nested columns, folded without recursion."""

from pyspark.sql import Column
from pyspark.sql import functions as F

TEXTS = "array<string>"


def no_texts() -> Column:
    return F.array().cast(TEXTS)


def graph_errors(graph: Column) -> Column:
    """What makes a graph ill-formed: repeated ids, inputs not yet defined, outputs defined before, an unknown final output."""
    ids = F.transform(graph["nodes"], lambda n: n["id"])
    start = F.struct(ids.alias("known"), no_texts().alias("errors"))

    def step(s: Column, o: Column) -> Column:
        unknown = F.transform(F.array_except(o["inputs"], s["known"]), lambda i: F.concat(F.lit("undefined_input:"), i))
        again = F.when(F.array_contains(s["known"], o["output"]), F.array(F.concat(F.lit("repeated_output:"), o["output"]))).otherwise(no_texts())
        return F.struct(F.array_union(s["known"], F.array(o["output"])).alias("known"), F.concat(s["errors"], unknown, again).alias("errors"))

    end = F.aggregate(graph["operations"], start, step)
    repeated = F.when(F.size(F.array_distinct(ids)) < F.size(ids), F.array(F.lit("repeated_node_id"))).otherwise(no_texts())
    final = F.when(~F.array_contains(end["known"], graph["final_output"]), F.array(F.lit("undefined_final_output"))).otherwise(no_texts())
    return F.concat(repeated, end["errors"], final)


def reaching_final(graph: Column) -> Column:
    """Ids on a path to the final output. Operations stand in order, so one fold from the last to the first finds all."""
    return F.aggregate(F.reverse(graph["operations"]), F.array(graph["final_output"]), lambda s, o: F.when(F.array_contains(s, o["output"]), F.array_union(s, o["inputs"])).otherwise(s))


def disconnected_key_nodes(graph: Column) -> Column:
    keys = F.transform(F.filter(graph["nodes"], lambda n: n["key"]), lambda n: n["id"])
    return F.array_except(keys, reaching_final(graph))


def unknown_claim_references(claims: Column, node_ids: Column) -> Column:
    known = F.concat(node_ids, F.transform(claims, lambda c: c["claim_id"]))
    return F.array_except(F.flatten(F.transform(claims, lambda c: c["supported_by"])), known)


def _settled(claims: Column, ready) -> Column:
    """Ids of the claims that become ready, ready(claim, ids so far), in as many rounds as there are claims."""

    def sweep(done: Column, _: Column) -> Column:
        return F.aggregate(claims, done, lambda s, c: F.when(ready(c, s), F.array_union(s, F.array(c["claim_id"]))).otherwise(s))

    return F.aggregate(F.sequence(F.lit(1), F.greatest(F.size(claims), F.lit(1))), no_texts(), sweep)


def ungrounded_claims(claims: Column, node_ids: Column) -> Column:
    """Claims of which no reference is evidence or a claim that is grounded itself."""
    grounded = _settled(claims, lambda c, s: F.arrays_overlap(c["supported_by"], F.concat(node_ids, s)))
    return F.array_except(F.transform(claims, lambda c: c["claim_id"]), grounded)


def circular_claims(claims: Column) -> Column:
    """Claims that rest on each other in a circle, and those that rest on such, whatever else they rest on."""
    names = F.transform(claims, lambda c: c["claim_id"])
    straight = _settled(claims, lambda c, s: F.size(F.array_except(F.array_intersect(c["supported_by"], names), s)) == 0)
    return F.array_except(names, straight)
