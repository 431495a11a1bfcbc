"""Declared columns of the served tables."""

from __future__ import annotations

SPECIES_HEX = "specieskey string, year int, h3_r4 string, h3_r5 string, h3_r6 string, h3_r7 string, occurrences bigint"
SPECIES_CARD = (
    "specieskey string, scientificname string, col_name string, col_authorship string, name_source string, col_release string, species string, kingdom string, phylum string, class string, `order` string, family string, genus string, "
    "record_count bigint, records_no_year bigint, first_year int, last_year int, n_datasets int, min_lat double, max_lat double, min_lon double, max_lon double, image_identifier string, image_references string, image_creator string, "
    "image_rightsholder string, image_license_code string, image_license_rank int, image_license_source string, image_specieskey string, top_datasets array<struct<datasetkey: string, title: string, records: bigint>>, "
    "merged_keys array<string>, merged_record_count bigint, merged_names array<struct<key: string, name: string, authorship: string>>"
)
STATUS = (
    "gbif_species_key string, species_name string, status_display string, has_multiple boolean, has_separate_bcsee_species boolean, statuses array<string>, element_codes array<string>, "
    "entries array<struct<status: string, scientific_label: string, name_source: string, common_label: string, classification_level: string, is_species_level: boolean, is_gbif_synonym: boolean, matched_species_keys: array<string>, element_codes: array<string>>>, "
    "matched_species_keys array<string>, status_source string, status_source_date string, status_pulled_on string"
)
DATASETS = (
    "id string, title string, abstract string, subjects array<string>, publisher string, issued string, source string, source_name string, link string, link_type string, licences array<struct<name: string, uri: string>>, "
    "final_class string, frontend_group string, mappable boolean, organisms array<string>, copy_count bigint, other_copies array<struct<id: string, source: string, source_name: string, link: string>>"
)
LINKS = "dataset_id string, position bigint, name_as_written string, match_status string, specieskey string, matched_name string, matched_field string"
CHECKS = "dataset_id string, catalogue_checked string, checked_on string, checked_how string, access string, access_until string, access_note string, access_matches_record boolean, licences array<struct<name: string, uri: string>>, removed boolean"
TABLES = {"species_hex": SPECIES_HEX, "species_card": SPECIES_CARD, "bcsee_status": STATUS, "datasets": DATASETS, "dataset_species_links": LINKS, "dataset_source_checks": CHECKS}
RANKS = ["kingdom", "phylum", "class", "order", "family", "genus"]
