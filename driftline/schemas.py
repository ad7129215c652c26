"""Declared schemas of every table the package reads or writes.

Nothing is inferred from data. Repeated column families are built from a count.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(spec: str) -> T.StructType:
    """``"a:int b:string"`` to a StructType."""
    schema = T.StructType()
    for item in spec.split():
        name, kind = item.split(":", 1)
        schema.add(name, _KINDS[kind])
    return schema


_KINDS = {
    "int": T.IntegerType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "binary": T.BinaryType(),
    "strings": T.ArrayType(T.StringType()),
    "measure": T.DecimalType(18, 4),
    "money": T.DecimalType(18, 2),
    "latitude": T.DecimalType(8, 4),
    "longitude": T.DecimalType(9, 4),
    "elevation": T.DecimalType(5, 1),
    "anomaly": T.DecimalType(10, 4),
}


def _family(prefix: str, count: int, kind: str) -> str:
    return " ".join(f"{prefix}{i}:{kind}" for i in range(1, count + 1))


# --- climate ---------------------------------------------------------------

DAILY_OBSERVATION = _struct(
    "station_id:string observation_date:date element:string value:measure "
    "mflag:string qflag:string sflag:string"
)

WEATHER_STATION = _struct(
    "station_id:string latitude:latitude longitude:longitude elevation:elevation "
    "state:string station_name:string gsn_flag:string hcn_crn_flag:string wmo_id:string"
)

MONTH_NAMES = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]

YEARLY_ANOMALY = _struct(
    "year:int "
    + " ".join(f"{m.lower()}:anomaly" for m in MONTH_NAMES)
    + " j_d:anomaly d_n:anomaly djf:anomaly mam:anomaly jja:anomaly son:anomaly"
)

SEA_ICE = _struct(
    "year:int month:int day:int extent:anomaly missing:anomaly source_data:string"
)

LOAD_EVENT = _struct(
    "file_name:string status:string last_updated:timestamp csv_record_count:long "
    "inserted_row_count:long error_condition:string seq:long batch_id:string generation:long station_id:string"
)

# --- sky catalogue: fixed column order of the published source files ---------

STAR_CATALOGUE = _struct(
    "solution_id:long designation:string source_id:long random_index:long ref_epoch:double "
    "ra:double ra_error:double dec:double dec_error:double parallax:double parallax_error:double "
    "parallax_over_error:double pmra:double pmra_error:double pmdec:double pmdec_error:double "
    "ra_dec_corr:double ra_parallax_corr:double ra_pmra_corr:double ra_pmdec_corr:double "
    "dec_parallax_corr:double dec_pmra_corr:double dec_pmdec_corr:double parallax_pmra_corr:double "
    "parallax_pmdec_corr:double pmra_pmdec_corr:double astrometric_n_obs_al:int "
    "astrometric_n_obs_ac:int astrometric_n_good_obs_al:int astrometric_n_bad_obs_al:int "
    "astrometric_gof_al:double astrometric_chi2_al:double astrometric_excess_noise:double "
    "astrometric_excess_noise_sig:double astrometric_params_solved:int "
    "astrometric_primary_flag:boolean astrometric_weight_al:double "
    "astrometric_pseudo_colour:double astrometric_pseudo_colour_error:double "
    "mean_varpi_factor_al:double astrometric_matched_observations:int "
    "visibility_periods_used:int astrometric_sigma5d_max:double frame_rotator_object_type:int "
    "matched_observations:int duplicated_source:boolean phot_g_n_obs:int phot_g_mean_flux:double "
    "phot_g_mean_flux_error:double phot_g_mean_flux_over_error:double phot_g_mean_mag:double "
    "phot_bp_n_obs:int phot_bp_mean_flux:double phot_bp_mean_flux_error:double "
    "phot_bp_mean_flux_over_error:double phot_bp_mean_mag:double phot_rp_n_obs:int "
    "phot_rp_mean_flux:double phot_rp_mean_flux_error:double phot_rp_mean_flux_over_error:double "
    "phot_rp_mean_mag:double phot_bp_rp_excess_factor:double phot_proc_mode:int bp_rp:double "
    "bp_g:double g_rp:double radial_velocity:double radial_velocity_error:double "
    "rv_nb_transits:int rv_template_teff:double rv_template_logg:double rv_template_fe_h:double "
    "phot_variable_flag:string l:double b:double ecl_lon:double ecl_lat:double priam_flags:long "
    "teff_val:double teff_percentile_lower:double teff_percentile_upper:double a_g_val:double "
    "a_g_percentile_lower:double a_g_percentile_upper:double e_bp_min_rp_val:double "
    "e_bp_min_rp_percentile_lower:double e_bp_min_rp_percentile_upper:double flame_flags:int "
    "radius_val:double radius_percentile_lower:double radius_percentile_upper:double "
    "lum_val:double lum_percentile_lower:double lum_percentile_upper:double"
)

# --- migration tables --------------------------------------------------------

WIN_LOGS = _struct(
    " ".join(
        [
            "id:long",
            _family("text_col", 130, "string"),
            _family("int_col", 59, "int"),
            _family("bigint_col", 20, "long"),
            _family("timestamp_col", 6, "timestamp_ntz"),
            _family("numeric_col", 5, "money"),
            _family("boolean_col", 2, "boolean"),
            _family("inet_col", 2, "string"),
            _family("double_col", 2, "double"),
            "varchar_col:string",
        ]
    )
)

ALL_FACTS = _struct(
    " ".join(
        [
            _family("int_col", 49, "int"),
            _family("numeric_col", 22, "money"),
            _family("text_array_col", 12, "strings"),
            _family("hll_col", 12, "binary"),
            _family("text_col", 9, "string"),
            "event_time:timestamp_ntz",
        ]
    )
)

BEESWAX = _struct(
    " ".join(
        [
            "id:long",
            _family("text_col", 7, "string"),
            _family("int_col", 6, "int"),
            _family("bigint_col", 3, "long"),
            "config_json:string metadata_json:string",
            "created_at:timestamp_ntz updated_at:timestamp_ntz is_active:boolean",
        ]
    )
)


def without(schema: T.StructType, *names: str) -> T.StructType:
    """Schema minus the named columns, e.g. the surrogate key a load file leaves out."""
    return T.StructType([f for f in schema.fields if f.name not in names])
