"""Image addresses. Host and version are parameters; NULL in gives NULL out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from medalstar.functions import lookups
from medalstar.functions.scalars import code_lookup


@dataclass(frozen=True)
class Assets:
    cdn: str = lookups.ASSET_CDN
    version: str = lookups.ASSET_VERSION
    emblem_base: str = lookups.EMBLEM_BASE

    def _versioned(self, folder: str, name: Column) -> Column:
        return F.concat(F.lit(f"{self.cdn}/{self.version}/img/{folder}/"), name, F.lit(".png"))

    def _artwork(self, folder: str, champion: Column) -> Column:
        return F.concat(F.lit(f"{self.cdn}/img/champion/{folder}/"), champion, F.lit("_0.jpg"))

    def champion_icon(self, champion: Column) -> Column:
        return self._versioned("champion", champion)

    def champion_splash(self, champion: Column) -> Column:
        return self._artwork("splash", champion)

    def champion_loading(self, champion: Column) -> Column:
        return self._artwork("loading", champion)

    def item(self, item_id: Column) -> Column:
        return self._versioned("item", item_id.cast("string"))

    def item_slot(self, item_id: Column) -> Column:
        """NULL for an empty slot (0, negative or NULL)."""
        return F.when(item_id > 0, self.item(item_id))

    def spell(self, spell_key: Column) -> Column:
        return self._versioned("spell", spell_key)

    def known_spell(self, spell_id: Column) -> Column:
        """NULL for a spell outside the fixed table."""
        return self.spell(code_lookup(spell_id, {code: key for code, key, _ in lookups.SPELLS}))

    def _rune(self, path: Column) -> Column:
        return F.concat(F.lit(f"{self.cdn}/img/perk-images/Styles/"), path)

    def keystone(self, keystone_id: Column) -> Column:
        return self._rune(code_lookup(keystone_id, lookups.KEYSTONES))

    def rune_tree(self, tree_id: Column) -> Column:
        return self._rune(code_lookup(tree_id, lookups.RUNE_TREES))

    def rank_emblem(self, tier: Column) -> Column:
        """NULL for a tier without an emblem."""
        known = F.when(tier.isin(lookups.EMBLEM_TIERS), F.lower(tier))
        return F.concat(F.lit(f"{self.emblem_base}/emblem-"), known, F.lit(".png"))
