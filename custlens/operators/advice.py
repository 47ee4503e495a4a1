"""Rule-based recommendations. All texts are fixed values that reports show as they are."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custlens.functions.columns import attach, one_row
from custlens.functions.order_stats import medians, quantile_struct
from custlens.operators.enrich import lookup_join
from custlens.operators.marketing import best_worst, kpi_totals, trend_signal

# Recommendation per rule.
REACTIVATE = "Lancer une campagne de réactivation avec des offres exclusives."
LOYALTY = "Proposer un programme de fidélité premium avec des avantages exclusifs."
VIP = "Offrir un service client personnalisé et des avantages VIP."
GENERIC = [
    "Personnaliser les communications pour le segment %s.",
    "Analyser les préférences d'achat du segment %s pour des recommandations plus précises.",
]

# Strategy texts.
HIGH_VALUE = {
    "objective": "Maximiser la valeur à vie",
    "action": "Programme de fidélité premium",
    "channels": ["Email personnalisé", "Téléphone", "Événements exclusifs"],
    "budget_share": 0.2,
}
LOWER_VALUE = {
    "objective": "Augmenter la fréquence d'achat",
    "action": "Offres de réduction sur le prochain achat",
    "channels": ["Emailing", "Réseaux sociaux", "Publicité ciblée"],
    "budget_share": 0.1,
}
RARE_BUYERS = {
    "objective": "Augmenter la fréquence d'achat",
    "action": "Programme de fidélité avec récompenses",
    "kpi": "Augmenter la fréquence d'achat de 30% sur 6 mois",
}
LOW_SCORE = {
    "objective": "Relancer les clients inactifs",
    "action": "Campagne de relance personnalisée",
    "kpi": "Taux de réactivation de 15% dans les 3 mois",
}

# Titles of campaign recommendations.
CAMPAIGN_TITLES = {
    "low_roi": "Optimisation des dépenses publicitaires",
    "low_ctr": "Amélioration du taux de clics",
    "best_segment": "Ciblage des segments performants",
    "worst_segment": "Réévaluation des segments sous-performants",
    "rising_sales": "Capitalisation sur la tendance positive",
}

# Objective, actions and channels of segments 1 to 4.
PLAYBOOK = [
    (
        1,
        "Fidélisation",
        [
            "Programme de fidélité avec récompenses personnalisées",
            "Offres exclusives pour les clients fidèles",
            "Contenu personnalisé basé sur l'historique d'achat",
        ],
        ["Email", "Application mobile", "Réseaux sociaux"],
    ),
    (
        2,
        "Récupération",
        [
            "Campagnes de remarketing ciblées",
            "Offres spéciales pour les clients inactifs",
            "Enquêtes de satisfaction",
        ],
        ["Email", "SMS", "Publicité ciblée"],
    ),
    (
        3,
        "Développement",
        [
            "Programmes d'upselling et cross-selling",
            "Contenu éducatif sur les produits",
            "Essais gratuits ou démos",
        ],
        ["Email", "Site web", "Réseaux sociaux"],
    ),
    (
        4,
        "Rétention",
        [
            "Service client premium",
            "Accès anticipé aux nouvelles collections",
            "Programme de parrainage rémunéré",
        ],
        ["Téléphone", "Email VIP", "Événements exclusifs"],
    ),
]


def _texts(*choices: Column) -> Column:
    return F.array_compact(F.array(*choices))


def _literals(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def segment_recommendations(
    segments: DataFrame,
    segment: str = "segment",
    monetary: str = "monetary",
    idle_days: int = 180,
    many_orders: int = 10,
) -> DataFrame:
    """(segment, recommendations) from medians per segment and the overall upper quartile of monetary."""
    present = segments.dropna(subset=[segment])
    middle = medians(present, ["recency", "frequency", monetary], [segment])
    upper = quantile_struct(segments, [monetary], [0.75])[f"{monetary}_q"][0]
    recency, frequency, value = (F.col(f"{c}_median") for c in ("recency", "frequency", monetary))
    specific = _texts(
        F.when(recency > idle_days, REACTIVATE).when(frequency > many_orders, LOYALTY),
        F.when(value > upper, VIP),
    )
    generic = F.array(*[F.format_string(text, F.col(segment).cast("string")) for text in GENERIC])
    every = present.select(segment).distinct().join(middle, segment, "left")
    return every.select(segment, F.when(F.size(specific) > 0, specific).otherwise(generic).alias("recommendations"))


def segment_strategies(characteristics: DataFrame, segment: str = "segment") -> DataFrame:
    """Objectives, channels, actions, budget and KPIs per segment, from the segment characteristics.

    A segment counts as valuable above the unweighted mean of the segment means.
    """
    overall = one_row(characteristics, F.avg("avg_clv").alias("mean"))["mean"]
    clv = F.col("avg_clv")
    valuable = F.coalesce(clv > overall, F.lit(False))
    rare = F.col("avg_purchase_freq") < 1
    weak = F.col("avg_rfm_score") < 5

    def by_value(part: str) -> Column:
        return F.when(valuable, F.lit(HIGH_VALUE[part])).otherwise(F.lit(LOWER_VALUE[part]))

    def extra(part: str) -> list[Column]:
        return [F.when(rare, F.lit(RARE_BUYERS[part])), F.when(weak, F.lit(LOW_SCORE[part]))]

    channels = F.when(valuable, _literals(HIGH_VALUE["channels"])).otherwise(_literals(LOWER_VALUE["channels"]))
    return characteristics.select(
        segment,
        _texts(by_value("objective"), *extra("objective")).alias("objectives"),
        channels.alias("channels"),
        _texts(by_value("action"), *extra("action")).alias("actions"),
        (clv * by_value("budget_share")).alias("budget"),
        _texts(*extra("kpi")).alias("kpis"),
    )


def campaign_recommendations(
    campaigns: DataFrame,
    segment_metrics: DataFrame,
    daily: DataFrame,
    segment: str = "segment",
    value: str = "total_revenue",
    roi_goal: float = 100,
    ctr_goal: float = 2,
) -> DataFrame:
    """(position, rule, title, subject, value): the advice that applies, from one-row KPI tables."""
    kpis = kpi_totals(campaigns)
    ends = best_worst(segment_metrics, segment, "ROI")
    found = one_row(
        ends, *[F.first(f"{side}_{what}").alias(f"{side}_{what}") for side in ("best", "worst") for what in (segment, "ROI")]
    )
    trend = one_row(trend_signal(daily, value), F.first("is_rising").alias("is_rising"), F.first("pct_above").alias("pct_above"))
    nobody = F.lit(None).cast("string")
    rules = [
        ("low_roi", F.col("avg_roi") < roi_goal, nobody, F.col("avg_roi")),
        ("low_ctr", F.col("avg_ctr") < ctr_goal, nobody, F.col("avg_ctr")),
        ("best_segment", F.lit(True), F.col(f"_ends.best_{segment}").cast("string"), F.col("_ends.best_ROI")),
        ("worst_segment", F.lit(True), F.col(f"_ends.worst_{segment}").cast("string"), F.col("_ends.worst_ROI")),
        ("rising_sales", F.col("_trend.is_rising"), nobody, F.col("_trend.pct_above")),
    ]
    rows = F.array(
        *[
            F.struct(
                F.lit(i + 1).alias("position"),
                F.lit(rule).alias("rule"),
                F.lit(CAMPAIGN_TITLES[rule]).alias("title"),
                subject.alias("subject"),
                amount.cast("double").alias("value"),
                applies.alias("applies"),
            )
            for i, (rule, applies, subject, amount) in enumerate(rules)
        ]
    )
    return attach(attach(kpis, "_ends", found), "_trend", trend).select(F.inline(rows)).filter("applies").drop("applies")


def segment_playbook(segments: DataFrame, segment: str = "segment") -> DataFrame:
    """Objective, actions and channels for every segment; segments outside the playbook get NULL."""
    book = segments.sparkSession.createDataFrame(
        PLAYBOOK, "number int, objective string, actions array<string>, channels array<string>"
    )
    names = segments.dropna(subset=[segment]).select(segment).distinct().withColumn("number", F.col(segment).try_cast("int"))
    return lookup_join(names, book, "number", ["objective", "actions", "channels"]).drop("number")
