"""Settings and lookup values shared by every phase."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

SEED = 42

# Product category -> super-category.
SUPER_CATEGORIES = {
    "computers_accessories": "Electronics",
    "computers": "Electronics",
    "electronics": "Electronics",
    "tablets_printing_image": "Electronics",
    "telephony": "Electronics",
    "fixed_telephony": "Electronics",
    "consoles_games": "Electronics",
    "audio": "Electronics",
    "signaling_and_security": "Electronics",
    "security_and_services": "Electronics",
    "pc_gamer": "Electronics",
    "small_appliances": "Electronics",
    "small_appliances_home_oven_and_coffee": "Electronics",
    "portable_kitchen_food_processors": "Electronics",
    "air_conditioning": "Electronics",
    "fashion_bags_accessories": "Fashion",
    "fashion_shoes": "Fashion",
    "fashion_male_clothing": "Fashion",
    "fashion_underwear_beach": "Fashion",
    "fashion_sport": "Fashion",
    "fashio_female_clothing": "Fashion",
    "fashion_childrens_clothes": "Fashion",
    "luggage_accessories": "Fashion",
    "watches_gifts": "Fashion",
    "cool_stuff": "Fashion",
    "furniture_decor": "Home & Living",
    "furniture_living_room": "Home & Living",
    "furniture_bedroom": "Home & Living",
    "furniture_mattress_and_upholstery": "Home & Living",
    "home_confort": "Home & Living",
    "home_comfort_2": "Home & Living",
    "home_construction": "Home & Living",
    "garden_tools": "Home & Living",
    "housewares": "Home & Living",
    "kitchen_dining_laundry_garden_furniture": "Home & Living",
    "costruction_tools_garden": "Home & Living",
    "construction_tools_construction": "Home & Living",
    "construction_tools_lights": "Home & Living",
    "construction_tools_safety": "Home & Living",
    "costruction_tools_tools": "Home & Living",
    "la_cuisine": "Home & Living",
    "flowers": "Home & Living",
    "health_beauty": "Health & Beauty",
    "perfumery": "Health & Beauty",
    "diapers_and_hygiene": "Health & Beauty",
    "sports_leisure": "Sports & Leisure",
    "baby": "Baby & Kids",
    "toys": "Baby & Kids",
    "christmas_supplies": "Baby & Kids",
    "books_general_interest": "Books & Media",
    "books_technical": "Books & Media",
    "books_imported": "Books & Media",
    "dvds_blu_ray": "Books & Media",
    "cds_dvds_musicals": "Books & Media",
    "cine_photo": "Books & Media",
    "music": "Books & Media",
    "musical_instruments": "Books & Media",
    "arts_and_craftmanship": "Books & Media",
    "art": "Books & Media",
    "food_drink": "Food & Drink",
    "food": "Food & Drink",
    "drinks": "Food & Drink",
    "auto": "Auto & Industry",
    "industry_commerce_and_business": "Auto & Industry",
    "construction_tools_tools": "Auto & Industry",
    "office_furniture": "Office & Stationery",
    "stationery": "Office & Stationery",
    "pet_shop": "Pet Shop",
    "bed_bath_table": "Bed, Bath & Table",
    "market_place": "Bed, Bath & Table",
}

# State -> region.
REGIONS = {
    "SP": "Southeast", "RJ": "Southeast", "MG": "Southeast", "ES": "Southeast",
    "PR": "South", "SC": "South", "RS": "South",
    "BA": "Northeast", "PE": "Northeast", "CE": "Northeast",
    "MA": "Northeast", "AL": "Northeast", "RN": "Northeast",
    "PB": "Northeast", "SE": "Northeast", "PI": "Northeast",
    "PA": "North", "AM": "North", "RO": "North",
    "TO": "North", "AC": "North", "AP": "North", "RR": "North",
    "GO": "Central-West", "DF": "Central-West",
    "MT": "Central-West", "MS": "Central-West",
}

# Acquisition channel -> (share of customers, cost per customer).
CHANNELS = {
    "Organic": (0.30, 0),
    "Paid Search": (0.25, 50),
    "Social": (0.20, 35),
    "Referral": (0.15, 20),
    "Email": (0.10, 15),
}

# Gender -> share of customers.
GENDERS = {"M": 0.48, "F": 0.48, "Other": 0.04}

# Value tier -> cost of one retention intervention.
INTERVENTION_COSTS = {"High Value": 50, "Medium Value": 20, "Low Value": 5}

# Segment -> probability that an intervention succeeds.
SUCCESS_PROBABILITIES = {
    "Champions": 0.70,
    "Loyal Customers": 0.65,
    "Potential Loyalists": 0.60,
    "At Risk": 0.50,
    "High Value At Risk": 0.45,
    "Needs Attention": 0.40,
    "Dormant": 0.20,
}

# Substring of the category -> return rate, first match wins.
RETURN_RATES = {
    "electronics": 0.12,
    "home": 0.08,
    "fashion": 0.18,
    "food": 0.03,
    "beauty": 0.10,
    "health": 0.08,
    "sports": 0.07,
    "books": 0.02,
    "toys": 0.09,
    "baby": 0.06,
}

# Engagement counter -> weight in the engagement score.
ENGAGEMENT_WEIGHTS = {
    "emails_opened_30d": 0.20,
    "website_visits_30d": 0.30,
    "campaign_clicks_30d": 0.25,
    "app_sessions_30d": 0.25,
}

# Name -> weights of (value, churn risk, net benefit).
PRIORITY_WEIGHTS = (0.40, 0.35, 0.25)
WEIGHT_SETS = {
    "Default (40/35/25)": (0.40, 0.35, 0.25),
    "Value-Heavy (50/25/25)": (0.50, 0.25, 0.25),
    "Risk-Heavy (30/40/30)": (0.30, 0.40, 0.30),
    "Balanced (33/33/33)": (0.33, 0.34, 0.33),
}

# Names of value and risk tiers.
VALUE_TIERS = ["High Value", "Medium Value", "Low Value"]
RISK_TIERS = ["Low Risk", "Medium Risk", "High Risk"]


@dataclass(frozen=True)
class Settings:
    """Dates, rates and lookups. The defaults are the published configuration: fixed values,
    but for fit_rows; the silhouette's sample is as large as the published one."""

    start_date: dt.date = dt.date(2016, 9, 1)
    as_of: dt.date = dt.date(2018, 9, 1)
    split_date: dt.date = dt.date(2018, 6, 1)
    seed: int = SEED

    order_statuses: tuple = ("delivered", "shipped", "invoiced")
    default_category: str = "other"
    default_super_category: str = "Other"
    default_region: str = "Other"
    super_categories: dict = field(default_factory=lambda: dict(SUPER_CATEGORIES))
    regions: dict = field(default_factory=lambda: dict(REGIONS))
    channels: dict = field(default_factory=lambda: dict(CHANNELS))
    genders: dict = field(default_factory=lambda: dict(GENDERS))
    return_rates: dict = field(default_factory=lambda: dict(RETURN_RATES))
    default_return_rate: float = 0.05

    trend_days: int = 90
    recent_days: int = 30
    engagement_weights: dict = field(default_factory=lambda: dict(ENGAGEMENT_WEIGHTS))
    # What a customer without any valid purchase gets as recency: "zero" or "worst".
    null_recency: str = "zero"

    cogs_share: float = 0.55
    max_discount_pct: float = 40.0
    return_cost: float = 5.0
    ticket_cost: float = 10.0

    intervention_costs: dict = field(default_factory=lambda: dict(INTERVENTION_COSTS))
    success_probabilities: dict = field(default_factory=lambda: dict(SUCCESS_PROBABILITIES))
    default_success_probability: float = 0.35
    priority_weights: tuple = PRIORITY_WEIGHTS
    weight_sets: dict = field(default_factory=lambda: dict(WEIGHT_SETS))

    test_share: float = 0.20
    cluster_range: tuple = (3, 4, 5, 6, 7, 8)
    cluster_restarts: int = 10
    # Rows that a silhouette is averaged over, at most; their distances are to all rows.
    silhouette_rows: int = 10_000
    # Labelled rows that `churn.bounded` draws for a trial; classifiers are fitted on all rows.
    fit_rows: int = 200_000
    smote_neighbours: int = 5
    tree_depth: int = 8
    forest_trees: int = 200
    forest_depth: int = 12
    boosting_rounds: int = 200
    boosting_depth: int = 6
    boosting_rate: float = 0.1
    max_iter: int = 1000
