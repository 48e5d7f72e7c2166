"""Code sets, phenotype leaves and trees, derived concepts, version comparison."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.functions.timesem import seconds
from strandline.operators.disclosure import suppress
from strandline.operators.joins import window_join
from strandline.operators.sums import dealt
from strandline.sources.tables import persisted

Z95 = 1.959963984540054


def compile_codeset(dictionary: DataFrame, code: str, label: str, rules: list[tuple[str, str]]) -> DataFrame:
    """Members of a code set: rules are (kind, text) with kind exact, prefix, contains or regex, tried on the dictionary (small). code, label, rule, matched_in_dictionary;
    an exact code that the dictionary lacks stays, unmatched."""
    spark = dictionary.sparkSession
    tests = {"exact": lambda t: F.col(code) == t, "prefix": lambda t: F.col(code).startswith(t), "contains": lambda t: F.lower(label).contains(t.lower()), "regex": lambda t: F.col(code).rlike(t)}
    hits = [dictionary.where(tests[k](t)).select(F.col(code).alias("code"), F.col(label).alias("label"), F.lit(f"{k}:{t}").alias("rule"), F.lit(True).alias("matched_in_dictionary")) for k, t in rules]
    exact = [t for k, t in rules if k == "exact"]
    if exact:
        lone = spark.createDataFrame([(t, f"exact:{t}") for t in exact], "code string, rule string").join(dictionary.select(F.col(code).alias("code")), "code", "left_anti")
        hits.append(lone.select("code", F.lit(None).cast("string").alias("label"), "rule", F.lit(False).alias("matched_in_dictionary")))
    every = reduce(DataFrame.unionByName, hits)
    return every.groupBy("code").agg(F.max("label").alias("label"), F.min("rule").alias("rule"), F.max("matched_in_dictionary").alias("matched_in_dictionary"))


def leaf(events: DataFrame, grain: str, time: str, where: Column, least: int = 1, distinct: str | None = None) -> DataFrame:
    """grain, flag (always true), first: grains with at least ``least`` matching rows (or distinct values of a column), and when the first was."""
    n = F.countDistinct(distinct) if distinct else F.count("*")
    return events.where(where).groupBy(grain).agg(n.alias("_n"), F.min(time).alias("first")).where(F.col("_n") >= least).select(grain, F.lit(True).alias("flag"), "first")


def leaf_codes(events: DataFrame, grain: str, time: str, code: str, members: DataFrame, least: int = 1, distinct: str | None = None) -> DataFrame:
    """A leaf over rows whose code is a member of the code set."""
    return leaf(events.join(members.select(F.col("code").alias(code)).distinct(), code, "left_semi"), grain, time, F.lit(True), least, distinct)


def temporal(a: DataFrame, b: DataFrame, grain: str, relation: str, hours: float = 24) -> DataFrame:
    """Grains where an event of ``a`` stands in the relation (before, after, within_hours) to one of ``b``; both have grain and time. within_hours: b follows a within the hours."""
    x, y = a.select(grain, F.col("time").alias("_a")), b.select(grain, F.col("time").alias("_b"))
    if relation == "within_hours":
        hit = window_join(x, y, [grain], "_a", "_b", 0, hours)
    else:  # the extremes decide, so no pairs are needed
        f, g = (F.min("_a"), F.max("_b")) if relation == "before" else (F.max("_a"), F.min("_b"))
        two = x.groupBy(grain).agg(f.alias("_a")).join(y.groupBy(grain).agg(g.alias("_b")), grain)
        hit = two.where(F.col("_a") < F.col("_b") if relation == "before" else F.col("_a") > F.col("_b"))
    return hit.groupBy(grain).agg(F.min("_a").alias("first")).withColumn("flag", F.lit(True)).select(grain, "flag", "first")


def phenotype(population: DataFrame, grain: str, leaves: dict[str, DataFrame], tree: Column, onset: tuple[str, ...], how: str = "earliest") -> DataFrame:
    """population's grains with positive, onset (over the named leaves) and evidence (JSON of leaf flags). ``tree`` is a boolean Column over the leaf names."""
    tagged = [df.select(grain, F.lit(n).alias("leaf"), "first") for n, df in leaves.items()]
    per = reduce(DataFrame.unionByName, tagged).groupBy(grain).agg(*[F.min(F.when(F.col("leaf") == n, F.col("first"))).alias(f"{n}_at") for n in leaves])
    j = population.select(grain).distinct().join(per, grain, "left")
    for n in leaves:
        j = j.withColumn(n, F.col(f"{n}_at").isNotNull())
    at = [F.col(f"{n}_at") for n in onset]
    when = at[0] if len(at) == 1 else (F.least(*at) if how == "earliest" else F.greatest(*at))
    return j.select(grain, tree.alias("positive"), F.when(tree, when).alias("onset"), F.to_json(F.struct(*leaves)).alias("evidence"))


def phenotype_summary(p: DataFrame, by: list[str], k: int = 11) -> DataFrame:
    """by, n, positives, share; small counts hidden, and the share with them."""
    s = p.groupBy(*by).agg(F.count("*").alias("n"), F.count_if("positive").alias("positives"))
    s = s.withColumn("share", F.when(~F.col("positives").between(1, k - 1) & ~F.col("n").between(1, k - 1), F.col("positives") / F.col("n")))
    return suppress(s, ["n", "positives"], k)


def over(x: Column, y: Column) -> Column:
    """x / y of doubles as IEEE 754 has it, where Spark would raise: over zero it is infinite, its sign that of both signs (a zero's too), and NaN if both are zero. NaN is above all numbers in comparisons, as in DuckDB."""
    return F.when(y == 0, x * F.pow(y, F.lit(-1.0))).otherwise(F.try_divide(x, y))


def ratio_to_rolling_min(df: DataFrame, by: str, time: str, value: str, hours: float) -> Column:
    """Value over the key's smallest value in the hours before and at its time."""
    w = Window.partitionBy(by).orderBy(F.unix_micros(F.col(time).cast("timestamp"))).rangeBetween(-int(hours * 3600e6), 0)
    return over(F.col(value), F.min(value).over(w))


def kdigo_stage(df: DataFrame, by: str, time: str, creatinine: str) -> DataFrame:
    """Adds stage 0 to 3 by the published creatinine criteria: 1.5, 2 and 3 times the 7-day minimum, a rise of 0.3 within 48 h, or 4.0 with such a rise."""
    w = lambda h: Window.partitionBy(by).orderBy(F.unix_micros(F.col(time).cast("timestamp"))).rangeBetween(-h * 3600 * 1_000_000, 0)
    x = F.col(creatinine)
    low7, low48 = F.min(x).over(w(168)), F.min(x).over(w(48))
    d = df.withColumn("_r", over(x, low7)).withColumn("_d", x - low48)
    acute = (F.col("_d") >= 0.3) | (F.col("_r") >= 1.5)
    stage = F.when((F.col("_r") >= 3) | ((x >= 4.0) & acute), 3).when(F.col("_r") >= 2, 2).when(acute, 1).otherwise(0)
    return d.withColumn("stage", stage).drop("_r", "_d")


def urine_stage(df: DataFrame, by: str, time: str, volume: str, weight: str) -> DataFrame:
    """by, time, stage 0 to 3 by the published urine criteria: under 0.5 ml a kg and hour for 6 h (1) or 12 h (2), under 0.3 for 24 h or none at all for 12 h (3).

    A row's volume is what came since the unit's row before, so a rate is volume over weight and the time between rows; the first row has no such time and starts the watch. A criterion of h hours asks for h observed hours or more.
    Rows of one time are one row; rows without time, volume or a positive weight say nothing and are left out."""
    known = df.where(F.col(time).isNotNull() & F.col(volume).isNotNull() & (F.col(weight) > 0))
    rows = known.groupBy(by, time).agg(F.sum(F.col(volume) / F.col(weight)).alias("_v")).withColumn("_t", F.unix_micros(F.col(time).cast("timestamp")))
    d = rows.withColumn("_h", (F.col("_t") - F.lag("_t").over(Window.partitionBy(by).orderBy("_t"))) / 3600e6).withColumn("_v", F.when(F.col("_h").isNotNull(), F.col("_v")))
    rate = {}
    for h in (6, 12, 24):
        w = Window.partitionBy(by).orderBy("_t").rangeBetween(1 - h * 3600 * 1_000_000, 0)
        seen = F.sum("_h").over(w)
        d = d.withColumn(f"_r{h}", F.when(seen >= h, F.sum("_v").over(w) / seen))
        rate[h] = F.col(f"_r{h}")
    stage = F.when((rate[24] < 0.3) | (rate[12] == 0), 3).when(rate[12] < 0.5, 2).when(rate[6] < 0.5, 1).otherwise(0)
    return d.select(by, time, stage.alias("stage"))


def injury_stage(creatinine: DataFrame, urine: DataFrame, by: str, time: str, carry_hours: float = 6) -> DataFrame:
    """by, time, stage: at each time of either table (by, time, stage) the worst stage of both over the hours up to it. Times that several rows share are one."""
    each = creatinine.select(by, time, "stage").unionByName(urine.select(by, time, "stage")).groupBy(by, time).agg(F.max("stage").alias("stage"))
    w = Window.partitionBy(by).orderBy(F.unix_micros(F.col(time).cast("timestamp"))).rangeBetween(-int(carry_hours * 3600e6), 0)
    return each.select(by, time, F.max("stage").over(w).alias("stage"))


def worst_score_24h(df: DataFrame, by: str, time: str, components: list[str]) -> DataFrame:
    """Adds score: the sum of each component's worst (largest) value over the 24 hours up to the row; missing components give 0."""
    w = Window.partitionBy(by).orderBy(F.unix_micros(F.col(time).cast("timestamp"))).rangeBetween(-24 * 3600 * 1_000_000, 0)
    return df.withColumn("score", sum((F.coalesce(F.max(c).over(w), F.lit(0)) for c in components[1:]), F.coalesce(F.max(components[0]).over(w), F.lit(0))))


def sepsis3(infections: DataFrame, scores: DataFrame, by: str, before_hours: float = 48, after_hours: float = 24, least: int = 2) -> DataFrame:
    """by, onset: the earliest suspected infection with a score of at least ``least`` from before to after it. infections: by, infected_at; scores: by, scored_at, score."""
    hit = window_join(infections, scores.where(F.col("score") >= least), [by], "infected_at", "scored_at", before_hours, after_hours)
    return hit.groupBy(by).agg(F.min("infected_at").alias("onset"))


def suspicion_of_infection(antibiotics: DataFrame, cultures: DataFrame, by: str, culture_first_hours: float = 72, antibiotic_first_hours: float = 24) -> DataFrame:
    """For each antibiotic (by, given_at) the earliest culture (by, taken_at) up to 72 h before or 24 h after it; suspected_at is the earlier of the two."""
    pairs = window_join(antibiotics, cultures, [by], "given_at", "taken_at", culture_first_hours, antibiotic_first_hours)
    first = pairs.groupBy(by, "given_at").agg(F.min("taken_at").alias("taken_at"))
    return first.withColumn("suspected_at", F.least("given_at", "taken_at"))


def weighted_groups(flags: DataFrame, grain: str, group: str, weights: dict[str, int], beats: dict[str, str]) -> DataFrame:
    """grain, score: the sum of the weights of the groups a grain has; a group named in ``beats`` counts for nothing where the group that beats it is there too."""
    has = {g: F.max((F.col(group) == g).cast("int")) for g in weights}
    wide = flags.groupBy(grain).agg(*[c.alias(f"_{k}") for k, c in enumerate(has.values())])
    at = {g: F.col(f"_{k}") for k, g in enumerate(has)}
    terms = [F.when(at[beats[g]] == 1, 0).otherwise(at[g] * w) if g in beats else at[g] * w for g, w in weights.items()]
    return wide.select(grain, sum(terms[1:], terms[0]).cast("int").alias("score"))


def dual_groups(dx: DataFrame, grain: str, code: str, system: str, sets: DataFrame) -> DataFrame:
    """grain, group: each group that a row's code belongs to, once a grain. ``sets`` (group, system, prefix) holds both code systems' prefixes; a code is upper-cased, loses its dots and meets the prefixes of its own system alone.

    Distinct codes meet the sets in an equi-join on system and leading part, one for each prefix length in use (a handful of numbers); rows then meet the codes that have a group. The pairs found are written and dealt by their number, so no task grows with the rows. A null code or system belongs to none."""
    s = sets.select("group", F.col("system").alias("_s"), F.regexp_replace(F.upper("prefix"), r"\.", "").alias("_p")).where(F.length("_p") > 0).distinct()
    lengths = [r[0] for r in s.select(F.length("_p")).distinct().collect()]
    if not lengths:
        return dx.select(grain, F.lit(None).cast("string").alias("group")).limit(0)
    rows = dx.select(grain, F.col(system).alias("_s"), F.col(code).alias("_k"))
    codes = rows.select("_s", "_k").distinct().withColumn("_c", F.regexp_replace(F.upper("_k"), r"\.", ""))
    parts = codes.withColumn("_p", F.explode(F.array_distinct(F.array(*[F.substring("_c", 1, n) for n in lengths]))))
    known = persisted(parts.join(s, ["_s", "_p"]).groupBy("_s", "_k").agg(F.collect_set("group").alias("groups")), "codes")
    pairs = persisted(rows.join(known, ["_s", "_k"]).select(grain, F.explode("groups").alias("group")), "groups")
    return dealt(pairs, pairs.count(), grain).distinct()


def state_episodes(df: DataFrame, by: str, time: str, tiebreak: str, state: str, gap_hours: float) -> DataFrame:
    """by, state, episode, start, stop, n: runs of one state, broken by another state or a longer gap."""
    w = Window.partitionBy(by).orderBy(time, tiebreak)
    gap = seconds(time) - F.lag(seconds(time)).over(w)
    new = (F.lag(state).over(w).isNull() | (F.lag(state).over(w) != F.col(state)) | (gap > gap_hours * 3600)).cast("int")
    e = df.withColumn("_n", new).withColumn("episode", F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return e.groupBy(by, state, "episode").agg(F.min(time).alias("start"), F.max(time).alias("stop"), F.count("*").alias("n"))


def equivalent_dose(df: DataFrame, by: list[str], agent: str, rate: str, factors: dict[str, float]) -> DataFrame:
    """by, dose: rates weighted by the agents' factors; agents without a factor count for nothing."""
    f = F.coalesce(*[F.when(F.col(agent) == a, F.lit(x)) for a, x in factors.items()], F.lit(0.0))
    return df.groupBy(*by).agg(F.sum(F.col(rate) * f).alias("dose"))


def concept_counts(concepts: dict[str, DataFrame], k: int = 11) -> DataFrame:
    """concept, shown: row counts, small ones as <k."""
    each = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("concept"), "n") for name, df in concepts.items()]
    return reduce(DataFrame.unionByName, each).select("concept", F.when(F.col("n").between(1, k - 1), f"<{k}").otherwise(F.col("n").cast("string")).alias("shown"))


def point_score(points: list[tuple[Column, int]]) -> Column:
    """Sum of points whose condition holds; an unknown condition gives none."""
    terms = [F.when(F.coalesce(c, F.lit(False)), p).otherwise(0) for c, p in points]
    return sum(terms[1:], terms[0])


def sirs(temperature: Column, heart_rate: Column, resp_rate: Column, wbc: Column) -> Column:
    return point_score([((temperature > 38) | (temperature < 36), 1), (heart_rate > 90, 1), (resp_rate > 20, 1), ((wbc > 12) | (wbc < 4), 1)])


def wilson(x: Column, n: Column, z: float = Z95) -> tuple[Column, Column]:
    p = x / n
    mid, half, den = p + z * z / (2 * n), z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n)), 1 + z * z / n
    return (mid - half) / den, (mid + half) / den


def compare_versions(a: DataFrame, b: DataFrame, grain: str, population: DataFrame, stratum: str) -> DataFrame:
    """stratum, n, both, only_a, only_b, share_a, its Wilson bounds; a and b hold the positive grains of two versions."""
    j = population.select(grain, stratum).join(a.select(grain, F.lit(1).alias("_a")), grain, "left").join(b.select(grain, F.lit(1).alias("_b")), grain, "left")
    x, y = F.col("_a").isNotNull(), F.col("_b").isNotNull()
    s = j.groupBy(stratum).agg(F.count("*").alias("n"), F.count_if(x & y).alias("both"), F.count_if(x & ~y).alias("only_a"), F.count_if(~x & y).alias("only_b"))
    lo, hi = wilson(F.col("both") + F.col("only_a"), F.col("n"))
    return s.withColumn("share_a", (F.col("both") + F.col("only_a")) / F.col("n")).withColumn("low_a", lo).withColumn("high_a", hi)


def banded(x: Column, cuts: list[float], points: list[int]) -> Column:
    """Points of the half-open band [cut, next cut) that x lies in; points[0] below the first cut. An unknown x gives 0."""
    out = F.lit(points[0])
    for c, n in zip(cuts, points[1:], strict=True):
        out = F.when(x >= c, n).otherwise(out)
    return F.when(x.isNull(), 0).otherwise(out)


#: The published organ-failure bands, as (cuts, points) of each organ's laboratory measure.
ORGANS = {
    "pao2_fio2": ([100, 200, 300, 400], [4, 3, 2, 1, 0]),
    "platelets": ([20, 50, 100, 150], [4, 3, 2, 1, 0]),
    "bilirubin": ([1.2, 2.0, 6.0, 12.0], [0, 1, 2, 3, 4]),
    "gcs": ([6, 10, 13, 15], [4, 3, 2, 1, 0]),
    "creatinine": ([1.2, 2.0, 3.5, 5.0], [0, 1, 2, 3, 4]),
}


def organ_points(pao2_fio2: Column, ventilated: Column, platelets: Column, bilirubin: Column, pressure: Column, dopamine: Column, epinephrine: Column, norepinephrine: Column, gcs: Column, creatinine: Column, urine_day: Column) -> dict[str, Column]:
    """The six organ scores, 0 to 4 each: respiration (3 and 4 only if ventilated), coagulation, liver, circulation (mean pressure under 70, or vasopressor rates), nervous system, kidneys (creatinine or urine a day)."""
    breath = banded(pao2_fio2, *ORGANS["pao2_fio2"])
    rate = lambda c: F.coalesce(c, F.lit(0.0))
    other = F.greatest(rate(epinephrine), rate(norepinephrine))
    flow = F.when((rate(dopamine) > 15) | (other > 0.1), 4).when((rate(dopamine) > 5) | (other > 0), 3).when(rate(dopamine) > 0, 2).when(pressure < 70, 1).otherwise(0)
    urine = F.when(urine_day < 200, 4).when(urine_day < 500, 3).otherwise(0)
    return {
        "respiration": F.when(~F.coalesce(ventilated, F.lit(False)), F.least(breath, F.lit(2))).otherwise(breath), "coagulation": banded(platelets, *ORGANS["platelets"]), "liver": banded(bilirubin, *ORGANS["bilirubin"]),
        "circulation": flow, "nervous": banded(gcs, *ORGANS["gcs"]), "kidneys": F.greatest(banded(creatinine, *ORGANS["creatinine"]), urine),
    }


#: The published acute-physiology bands, as (cuts, points).
PHYSIOLOGY = {
    "heart_rate": ([40, 50, 100, 110, 120, 140, 155], [8, 5, 0, 1, 5, 7, 13, 17]),
    "pressure": ([40, 60, 70, 80, 100, 120, 130, 140], [23, 15, 7, 6, 0, 4, 7, 9, 10]),
    "temperature": ([33, 33.5, 34, 35, 36, 40], [20, 16, 13, 8, 2, 0, 4]),
    "resp_rate": ([6, 12, 14, 25, 35, 40, 50], [17, 8, 7, 0, 6, 9, 11, 18]),
    "hematocrit": ([41, 50], [3, 0, 3]),
    "wbc": ([1, 3, 20, 25], [19, 5, 0, 1, 5]),
    "creatinine": ([0.5, 1.5, 1.95], [3, 0, 4, 7]),
    "urine_day": ([400, 600, 900, 1500, 2000, 4000], [15, 8, 7, 5, 4, 0, 1]),
    "bun": ([17, 20, 40, 80], [0, 2, 7, 11, 12]),
    "sodium": ([120, 135, 155], [3, 2, 0, 4]),
    "albumin": ([2, 2.5, 4.5], [11, 6, 0, 4]),
    "bilirubin": ([2, 3, 5, 8], [0, 5, 6, 8, 16]),
    "glucose": ([40, 60, 200, 350], [8, 9, 0, 3, 5]),
}


def physiology_points(values: dict[str, Column]) -> Column:
    """Sum of the banded points of the named measures; one that isn't known gives none."""
    terms = [banded(x, *PHYSIOLOGY[name]) for name, x in values.items()]
    return sum(terms[1:], terms[0])


#: The published acid-base matrix. Cuts of pH, then for each band of pH the (cuts, points) of carbon-dioxide pressure.
ACID_BASE = (
    [7.2, 7.3, 7.35, 7.45, 7.5, 7.6],
    [([50], [12, 4]), ([30, 40, 50], [9, 6, 3, 2]), ([30, 45], [9, 0, 1]), ([30, 45], [5, 0, 1]), ([30, 35, 45], [5, 0, 2, 12]), ([40], [3, 12]), ([25, 40], [0, 3, 12])],
)
#: The published oxygenation points, by arterial oxygen pressure, or by the alveolar gradient of ventilated patients on half oxygen or more.
OXYGENATION = {"pao2": ([50, 70, 80], [15, 5, 2, 0]), "gradient": ([100, 250, 350, 500], [0, 7, 9, 11, 14])}
#: The published nervous-system matrix, eyes shut or open. Cuts of the verbal response, then for each band of it the (cuts, points) of the motor response; what can't occur with shut eyes has no points.
NERVOUS = {
    "shut": ([2, 4], [([3, 5], [48, 33, 16]), ([3, 5], [29, 24, 0]), ([], [0])]),
    "open": ([2, 4, 5], [([3, 5], [29, 24, 15]), ([3, 5, 6], [29, 24, 13, 10]), ([5, 6], [13, 8, 3]), ([6], [3, 0])]),
}


def matrix(x: Column, y: Column, cuts: list[float], rows: list[tuple[list[float], list[int]]]) -> Column:
    """Points of y in the row of bands that x's band names. An unknown x or y gives 0."""
    out = banded(y, *rows[0])
    for c, row in zip(cuts, rows[1:], strict=True):
        out = F.when(x >= c, banded(y, *row)).otherwise(out)
    return F.when(x.isNull(), 0).otherwise(out)


def acid_base_points(ph: Column, paco2: Column) -> Column:
    return matrix(ph, paco2, *ACID_BASE)


def alveolar_gradient(fio2: Column, pao2: Column, paco2: Column, barometric: float = 760.0, vapour: float = 47.0, quotient: float = 0.8) -> Column:
    """Alveolar less arterial oxygen pressure; fio2 is a share."""
    return fio2 * (barometric - vapour) - paco2 / quotient - pao2


def oxygenation_points(pao2: Column, paco2: Column, fio2: Column, ventilated: Column) -> Column:
    """By the gradient if ventilated with a share of oxygen of 0.5 or more, else by the pressure; 0 where the one that counts isn't known."""
    rich = F.coalesce(ventilated & (fio2 >= 0.5), F.lit(False))
    return F.when(rich, banded(alveolar_gradient(fio2, pao2, paco2), *OXYGENATION["gradient"])).otherwise(banded(pao2, *OXYGENATION["pao2"]))


def nervous_points(eyes: Column, verbal: Column, motor: Column) -> Column:
    """Of the coma scale's three responses; 0 if one isn't known."""
    return F.when(eyes.isNull(), 0).when(eyes > 1, matrix(verbal, motor, *NERVOUS["open"])).otherwise(matrix(verbal, motor, *NERVOUS["shut"]))
