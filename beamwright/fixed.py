"""Fixed values that results depend on: key lists, rule tables, defaults.

Nothing here is logic.  The lists are data that other systems agree on and are
stated as they are; operators take them as defaults and accept replacements.
"""

# fixed values: metadata defaults
UNKNOWN_EMAIL = "unknown@example.com"
UNKNOWN = "Unknown"
DEFAULT_USER = "8.3.2"
BEAMLINE_ALIASES = {"bl832": "8.3.2"}

# fixed values: catalogue keys
CATALOGUE_KEYS = [
    "/measurement/instrument/instrument_name",
    "/measurement/sample/experiment/beamline",
    "/measurement/sample/experiment/experiment_lead",
    "/measurement/sample/experiment/pi",
    "/measurement/sample/experiment/proposal",
    "/measurement/sample/experimenter/email",
    "/measurement/sample/experimenter/name",
    "/measurement/sample/file_name",
]

# fixed values: scientific keys (one of them is listed twice on purpose)
SCIENTIFIC_KEYS = [
    "/measurement/instrument/attenuator/setup/filter_y",
    "/measurement/instrument/camera_motor_stack/setup/tilt_motor",
    "/measurement/instrument/detection_system/objective/camera_objective",
    "/measurement/instrument/detection_system/scintillator/scintillator_type",
    "/measurement/instrument/detector/binning_x",
    "/measurement/instrument/detector/binning_y",
    "/measurement/instrument/detector/dark_field_value",
    "/measurement/instrument/detector/delay_time",
    "/measurement/instrument/detector/dimension_x",
    "/measurement/instrument/detector/dimension_y",
    "/measurement/instrument/detector/model",
    "/measurement/instrument/detector/pixel_size",
    "/measurement/instrument/detector/temperature",
    "/measurement/instrument/monochromator/setup/Z2",
    "/measurement/instrument/slits/setup/hslits_center",
    "/measurement/instrument/slits/setup/hslits_size",
    "/measurement/instrument/slits/setup/vslits_Lead_Flag",
    "/measurement/instrument/source/source_name",
    "/process/acquisition/dark_fields/dark_num_avg_of",
    "/process/acquisition/dark_fields/num_dark_fields",
    "/process/acquisition/flat_fields/i0_move_x",
    "/process/acquisition/flat_fields/i0_move_y",
    "/process/acquisition/flat_fields/i0cycle",
    "/process/acquisition/flat_fields/num_flat_fields",
    "/process/acquisition/flat_fields/usebrightexpose",
    "/process/acquisition/mosaic/tile_xmovedist",
    "/process/acquisition/mosaic/tile_xnumimg",
    "/process/acquisition/mosaic/tile_xorig",
    "/process/acquisition/mosaic/tile_xoverlap",
    "/process/acquisition/mosaic/tile_ymovedist",
    "/process/acquisition/mosaic/tile_ynumimg",
    "/process/acquisition/mosaic/tile_yorig",
    "/process/acquisition/mosaic/tile_yoverlap",
    "/process/acquisition/name",
    "/process/acquisition/rotation/blur_limit",
    "/process/acquisition/rotation/blur_limit",
    "/process/acquisition/rotation/multiRev",
    "/process/acquisition/rotation/nhalfCir",
    "/process/acquisition/rotation/num_angles",
    "/process/acquisition/rotation/range",
]

# fixed values: sampled series
SAMPLE_KEYS = [
    "/measurement/instrument/sample_motor_stack/setup/axis1pos",
    "/measurement/instrument/sample_motor_stack/setup/axis2pos",
    "/measurement/instrument/sample_motor_stack/setup/sample_x",
    "/measurement/instrument/sample_motor_stack/setup/axis5pos",
    "/measurement/instrument/camera_motor_stack/setup/camera_elevation",
    "/measurement/instrument/source/current",
    "/measurement/instrument/camera_motor_stack/setup/camera_distance",
    "/measurement/instrument/source/beam_intensity_incident",
    "/measurement/instrument/monochromator/energy",
    "/measurement/instrument/detector/exposure_time",
    "/measurement/instrument/time_stamp",
    "/measurement/instrument/monochromator/setup/turret2",
    "/measurement/instrument/monochromator/setup/turret1",
]

# fixed values: geometry column -> metadata key
GEOMETRY_KEYS = {
    "numangles": "/process/acquisition/rotation/num_angles",
    "angularrange": "/process/acquisition/rotation/range",
    "rotation_start": "/process/acquisition/rotation/rotation_start",
    "rotation_step": "/process/acquisition/rotation/rotation_step",
    "numslices": "/measurement/instrument/detector/dimension_y",
    "numrays": "/measurement/instrument/detector/dimension_x",
    "pixel_mm": "/measurement/instrument/detector/pixel_size",
    "i0cycle": "/process/acquisition/flat_fields/i0cycle",
    "nflat": "/process/acquisition/flat_fields/num_flat_fields",
    "ndark": "/process/acquisition/dark_fields/num_dark_fields",
}
DISTANCE_KEY = "/measurement/instrument/camera_motor_stack/setup/camera_distance"
ENERGY_KEY = "/measurement/instrument/monochromator/energy"
THETA_KEY = "/exchange/theta"

# fixed values: routing allow-lists (flow -> accepted parameters)
FLOW_PARAMETERS = {
    "alcf_recon_flow/alcf_recon_flow": ["file_path", "config"],
    "new_832_file_flow/new_file_832": ["file_path", "is_export_control", "config"],
    "nersc_recon_flow/nersc_recon_flow": ["file_path", "config"],
}
NEW_FILE_FLOW = "new_832_file_flow/new_file_832"

# fixed values: retention rules (flow, path kind, location, delay key, source, check)
RETENTION_RULES = [
    ("alcf", "raw", "alcf832_raw", "alcf", "alcf832_raw", "data832_raw"),
    ("alcf", "tiff", "alcf832_scratch", "alcf", "alcf832_scratch", "data832_scratch"),
    ("alcf", "zarr", "alcf832_scratch", "alcf", "alcf832_scratch", "data832_scratch"),
    ("alcf", "nersc tiff", "nersc832_alsdev_scratch", "nersc", "nersc832_alsdev_scratch", None),
    ("alcf", "nersc zarr", "nersc832_alsdev_scratch", "nersc", "nersc832_alsdev_scratch", None),
    ("alcf", "raw", "data832_raw", "data832", "data832_raw", None),
    ("alcf", "tiff", "data832_scratch", "data832", "data832_scratch", None),
    ("alcf", "zarr", "data832_scratch", "data832", "data832_scratch", None),
    ("nersc", "tiff", "data832_scratch", "data832", "data832_scratch", "nersc832_alsdev_scratch"),
    ("nersc", "zarr", "data832_scratch", "data832", "data832_scratch", "nersc832_alsdev_scratch"),
    ("nersc", "raw", "nersc832_alsdev_pscratch_raw", "nersc", "nersc832_alsdev_pscratch_raw", None),
    ("nersc", "tiff", "nersc832_alsdev_pscratch_scratch", "nersc", "nersc832_alsdev_pscratch_scratch", None),
    ("nersc", "zarr", "nersc832_alsdev_pscratch_scratch", "nersc", "nersc832_alsdev_pscratch_scratch", None),
    ("move", "file", "spot832", "spot832", "spot832", "data832"),
    ("move", "file", "data832", "data832", "data832", "nersc832"),
]
RETENTION_DAYS = {"alcf": 2, "data832": 3, "nersc": 7, "spot832": 2}

# fixed values: solver parameter defaults that overlay_params updates
SPLIT_SOLVER_DEFAULTS = {
    "run_split_reconstructions": "False",
    "n_modes": "1",
    "oversampling_factor": "1",
    "propagation_distance": "5e-05",
    "simulate_probe_translation": "True",
    "n_init_rounds": "1",
    "n_init_iter": "50",
    "n_final_iter": "50",
    "translation_randomization": "0",
    "probe_initialization": "None",
    "init_background": "False",
    "probe_support_radius": "None",
}
CAMERA_SOLVER_DEFAULTS = {
    "n_iter": "500",
    "period_illu_refine": "0",
    "period_bg_refine": "0",
    "use_illu_mask": "False",
}

# fixed values: task and job states
BAD_NICE_STATUS = ["FILE_NOT_FOUND", "PERMISSION_DENIED"]
FINISHED_STATUS = ["SUCCEEDED", "FAILED"]
TERMINAL_JOB_STATES = [
    "BOOT_FAIL", "CANCELLED", "COMPLETED", "DEADLINE", "FAILED",
    "NODE_FAIL", "OUT_OF_MEMORY", "PREEMPTED", "TIMEOUT",
]

# fixed values: imaging defaults
BEAM_HARDENING = (0.0, 1.0, 0.0, 0.0, 0.0, 0.004)
LENS_CENTER = (1280.0, 1080.0)
LENS_FACTORS = (1.00015076, 1.9289e-06, -2.4325e-08, 1.00439e-11, -3.99352e-15)
# Daubechies-5 scaling filter
DB5 = (
    0.160102397974125, 0.603829269797473, 0.724308528438574, 0.138428145901103,
    -0.242294887066190, -0.032244869585030, 0.077571493840065, -0.006241490213012,
    -0.012580751999016, 0.003335725285002,
)
