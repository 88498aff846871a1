"""Fixed lookup values, stated once and used by the dimensions, the fact and the checks.

Every value below has to equal the published game data for results to agree.
"""

from __future__ import annotations

# ---- Fixed values ----

ASSET_VERSION = "14.24.1"
ASSET_CDN = "https://ddragon.leagueoflegends.com/cdn"
EMBLEM_BASE = (
    "https://raw.communitydragon.org/latest/plugins/rcp-fe-lol-static-assets"
    "/global/default/ranked-emblem"
)

# spell id, asset key, display name
SPELLS = [
    (1, "SummonerBoost", "Cleanse"),
    (3, "SummonerExhaust", "Exhaust"),
    (4, "SummonerFlash", "Flash"),
    (6, "SummonerHaste", "Ghost"),
    (7, "SummonerHeal", "Heal"),
    (11, "SummonerSmite", "Smite"),
    (12, "SummonerTeleport", "Teleport"),
    (13, "SummonerMana", "Clarity"),
    (14, "SummonerDot", "Ignite"),
    (21, "SummonerBarrier", "Barrier"),
    (32, "SummonerSnowball", "Mark"),
]

# keystone id -> image path below the rune folder
KEYSTONES = {
    8005: "Precision/PressTheAttack/PressTheAttack.png",
    8008: "Precision/LethalTempo/LethalTempoTemp.png",
    8010: "Precision/Conqueror/Conqueror.png",
    8021: "Precision/FleetFootwork/FleetFootwork.png",
    8112: "Domination/Electrocute/Electrocute.png",
    8124: "Domination/Predator/Predator.png",
    8128: "Domination/DarkHarvest/DarkHarvest.png",
    8214: "Sorcery/SummonAery/SummonAery.png",
    8229: "Sorcery/ArcaneComet/ArcaneComet.png",
    8230: "Sorcery/PhaseRush/PhaseRush.png",
    8351: "Inspiration/GlacialAugment/GlacialAugment.png",
    8360: "Inspiration/UnsealedSpellbook/UnsealedSpellbook.png",
    8369: "Inspiration/FirstStrike/FirstStrike.png",
    8437: "Resolve/GraspOfTheUndying/GraspOfTheUndying.png",
    8439: "Resolve/VeteranAftershock/VeteranAftershock.png",
    8465: "Resolve/Guardian/Guardian.png",
    9923: "Domination/HailOfBlades/HailOfBlades.png",
}

# rune tree id -> image file below the rune folder
RUNE_TREES = {
    8000: "7201_Precision.png",
    8100: "7200_Domination.png",
    8200: "7202_Sorcery.png",
    8300: "7203_Inspiration.png",
    8400: "7204_Resolve.png",
}

# position -> symbol
ROLE_ICONS = {"TOP": "🛡️", "JUNGLE": "🌲", "MIDDLE": "⚔️", "BOTTOM": "🎯", "UTILITY": "💚"}
UNKNOWN_ROLE_ICON = "❓"

# tiers that have an emblem, highest first
EMBLEM_TIERS = [
    "CHALLENGER", "GRANDMASTER", "MASTER", "DIAMOND", "EMERALD",
    "PLATINUM", "GOLD", "SILVER", "BRONZE", "IRON",
]

# tiers the ladder is drawn from, highest first
LADDER_TIERS = ["CHALLENGER", "GRANDMASTER", "MASTER"]

# queue id -> name
QUEUES = {
    400: "Normal Draft",
    420: "Ranked Solo/Duo",
    430: "Normal Blind",
    440: "Ranked Flex",
    450: "ARAM",
}
OTHER_QUEUE = "Other"
RANKED_QUEUES = [420, 440]

# team id -> side
SIDES = {100: "blue", 200: "red"}
UNKNOWN_SIDE = "unknown"

# ---- End of fixed values ----
