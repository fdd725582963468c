"""Which registered queries stand for which operators of the inventory; each has SQL that computes it another way."""

import pytest

from aerolayer.plans.queries import QUERIES, SQL

STANDS_FOR = {
    "S1 S2 S3 W1 O1": "state_lines",
    "S4 J1 V4 V5 V6 V7": "navaid_resolve",
    "S5 Q1 Q2 Q3 Q4 Q5 Q6 Q7 W6 W7 V2": "dms_polygon",
    "S6 J10": "geojson_index",
    "S7 A7": "mask_merge",
    "S8": "mask_paths",
    "S9": "region_polygons",
    "S10 J3": "region_mapping",
    "S11 U3": "scene_required_keys",
    "S13": "href_extract",
    "S14 P7 V13": "chart_classify",
    "S15": "url_list",
    "S16 K16 K18": "raster_files",
    "G14 G15": "raster_corners",
    "S17": "virtual_paths",
    "S18": "html_bounds",
    "S19": "tag_lookup",
    "S20 P10 P13 W10": "argument_lists",
    "S21": "raster_downsample",
    "K1 K3": "feature_file",
    "K2": "feature_folder",
    "K9 W3 W4 W5 O5": "pmtiles_directory",
    "K13 P15 A5": "fetch_manifest",
    "K14 A6": "quarter_summary",
    "K17 P9 J4 A9 V15": "region_mosaic",
    "P1 P19 P20 V1 V3 V9": "obstacle_parse",
    "P2 P3": "obstacle_state_filter",
    "P4": "obstacle_errors",
    "P5": "navaid_type_filter",
    "P6 A2": "navaid_summary",
    "P8": "chart_selection",
    "P11 A17": "tile_level_stats",
    "P12": "region_polygons",
    "P14 J6": "boxes_intersect",
    "P16": "obstacle_feature_json",
    "J2 A8 V14": "chart_jobs",
    "J5 V8": "obstacle_decode",
    "J7 O3": "cycle_latest",
    "J8": "resume_pending",
    "J9 U1": "scenes_by_quarter",
    "J11": "raster_clip",
    "J12 U2": "mask_algebra",
    "A1": "obstacle_summary",
    "A3": "bounds_agg",
    "A4 G3": "bounds_to_wgs84",
    "A10": "dup_keys",
    "A11": "edge_mode",
    "A12 R18": "neatline",
    "A13 R17": "components",
    "A14": "largest_component",
    "A15": "corner_points",
    "A16 G10 G11": "pmtiles_zoom_map",
    "A18 R2 W8": "raster_smooth_k3",
    "A19": "archive_stats",
    "W2 R20": "extension_select",
    "W9 O6 R26": "scene_overlay",
    "W11": "ring_area",
    "O2": "cycles_found",
    "O4": "package_list",
    "V10 V11 V12": "chart_normalize",
    "V16 V18": "cycle_tokens",
    "V17": "url_parts",
    "V19": "quarter_bounds",
    "V20 G2": "identity_projection",
    "G1": "obstacle_lcc",
    "G4 G5": "tile_index",
    "G6 G9": "tile_enumerate",
    "G7": "tile_counts",
    "G8": "zoom_ladder",
    "G12": "pmtiles_tile_id",
    "G13": "densify",
    "Q9": "point_in_region",
    "R1": "raster_slope",
    "R3 R4": "raster_threshold",
    "R5 R6 R7 R8 R9 R10": "true_color",
    "R12": "palette_apply",
    "R13 R23": "palette_view",
    "R14": "background_mask",
    "R15": "flood_fill",
    "R16": "morphology",
    "R21": "component_prune",
    "R22": "main_and_islands",
    "T5": "stream_quarter_counts",
}


@pytest.mark.parametrize("ids", STANDS_FOR)
def test_operators_have_queries_with_sql(ids):
    assert STANDS_FOR[ids] in QUERIES and STANDS_FOR[ids] in SQL
