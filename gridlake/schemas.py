"""Canonical table schemas: fixed values, as table and column names are given.

Times of measurements are UTC timestamps without zone, the type Parquet files of
measurements carry; ``gridlake.streaming`` casts them where a watermark is used.
"""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "array<string>": T.ArrayType(T.StringType()),
    "array<bigint>": T.ArrayType(T.LongType()),
}


def _schema(columns: str) -> T.StructType:
    """Schema from ``name type`` pairs; needs no running session."""
    pairs = [c.strip().rsplit(" ", 1) for c in columns.split(",")]
    return T.StructType([T.StructField(n.strip().strip("`"), _TYPES[t]) for n, t in pairs])


POWER_MEASUREMENTS = _schema("""
    time timestamp_ntz, measurement_id string, bus_id string, bus_name string,
    voltage_magnitude double, voltage_angle_rad double, active_power_mw double,
    reactive_power_mvar double, frequency_hz double, measurement_quality int,
    source string, scenario_id string, case_name string
""")

GENERATOR_MEASUREMENTS = _schema("""
    time timestamp_ntz, measurement_id string, generator_id string,
    generator_name string, bus_id string, active_power_mw double,
    reactive_power_mvar double, available_capacity_mw double,
    commitment_status boolean, fuel_consumption double, marginal_cost double,
    ramp_rate_actual double, generator_type string, source string,
    scenario_id string, case_name string
""")

BRANCH_MEASUREMENTS = _schema("""
    time timestamp_ntz, measurement_id string, branch_id string,
    branch_name string, from_bus_id string, to_bus_id string,
    from_bus_active_power_mw double, from_bus_reactive_power_mvar double,
    to_bus_active_power_mw double, to_bus_reactive_power_mvar double,
    current_magnitude_pu double, loading_percentage double, in_service boolean,
    source string, scenario_id string, case_name string
""")

LOAD_MEASUREMENTS = _schema("""
    time timestamp_ntz, measurement_id string, load_id string, load_name string,
    bus_id string, active_power_mw double, reactive_power_mvar double,
    forecasted_active_power_mw double, forecast_error_mw double,
    load_type string, source string, scenario_id string, case_name string
""")

# Layout of the stored measurement tables: every loader writes all of these columns.
MEASUREMENTS = {
    "power_measurements": POWER_MEASUREMENTS,
    "generator_measurements": GENERATOR_MEASUREMENTS,
    "branch_measurements": BRANCH_MEASUREMENTS,
    "load_measurements": LOAD_MEASUREMENTS,
}

RENEWABLE_FORECASTS = _schema("""
    forecast_time timestamp_ntz, target_time timestamp_ntz, generator_id string,
    forecasted_power_mw double, confidence_lower_mw double,
    confidence_upper_mw double, forecast_horizon_hours int,
    forecast_model string, scenario_id string
""")

NETWORK_TOPOLOGY = _schema("""
    topology_id bigint, case_name string, version int, part_no int,
    num_parts int, num_buses bigint, num_generators bigint, num_branches bigint,
    num_loads bigint, base_mva double, system_data string, description string,
    source string, valid_from timestamp_ntz, valid_until timestamp_ntz
""")

CONTINGENCIES = _schema("""
    contingency_id string, topology_id bigint, contingency_name string,
    contingency_type string, affected_branches array<string>,
    affected_generators array<string>, probability double, severity_level int,
    description string
""")

EXECUTIONS = _schema("""
    execution_id string, execution_time timestamp_ntz, topology_id bigint,
    optimization_horizon_hours int, num_time_steps int, num_contingencies int,
    admm_rho double, app_beta double, app_gamma double, max_iterations int,
    convergence_tolerance double, convergence_status string,
    final_iteration int, objective_value double, solve_time_seconds double,
    triggered_by string
""")

DISPATCH_RESULTS = _schema("""
    execution_id string, time_step int, target_datetime timestamp_ntz,
    generator_id string, scenario_type string, active_power_mw double,
    reactive_power_mvar double, commitment_status boolean,
    generation_cost double
""")

BUS_RESULTS = _schema("""
    execution_id string, time_step int, target_datetime timestamp_ntz,
    bus_id string, scenario_type string, voltage_magnitude_pu double,
    voltage_angle_rad double, net_injection_mw double, lmp_energy double,
    lmp_congestion double, lmp_loss double, lmp_total double
""")

BRANCH_FLOW_RESULTS = _schema("""
    execution_id string, time_step int, target_datetime timestamp_ntz,
    branch_id string, scenario_type string, from_active_power_mw double,
    from_reactive_power_mvar double, to_active_power_mw double,
    to_reactive_power_mvar double, loading_percentage double,
    flow_constrained boolean, shadow_price double
""")

CONVERGENCE_HISTORY = _schema("""
    execution_id string, iteration int, primal_residual double,
    dual_residual double, objective_value double, iteration_time_seconds double
""")

QUALITY_METRICS = _schema("""
    check_time timestamp_ntz, table_name string, metric_type string,
    metric_name string, metric_value double, pass_fail string, details string,
    affected_records bigint
""")

TASK_LOGS = _schema("""
    pipeline_name string, dag_run_id string, task_id string,
    execution_date timestamp_ntz, start_time timestamp_ntz,
    end_time timestamp_ntz, status string, error_message string,
    records_processed bigint
""")

# --- file inputs ---------------------------------------------------------

BUS_CSV = _schema("""
    `Bus ID` bigint, `Bus Name` string, BaseKV double, Area string, Zone string,
    Vmin double, Vmax double
""")

GEN_CSV = _schema("""
    `GEN UID` string, `Bus ID` bigint, Fuel string, `PMin MW` double,
    `PMax MW` double, `QMin MVAR` double, `QMax MVAR` double,
    `Ramp Rate MW/Min` double, `Min Up Time Hr` double,
    `Min Down Time Hr` double, `Start Cost Cold $` double,
    `Fuel Price $/MMBTU` double, HR_avg_0 double, `Non Fuel O&M $/MWh` double,
    `Unit Group` string
""")

BRANCH_CSV = _schema("""
    UID string, `From Bus` bigint, `To Bus` bigint, R double, X double, B double,
    `Cont Rating` double, `STE Rating` double, `Tr Ratio` double,
    `Tr Angle` double
""")

BUS_MAP_CSV = _schema("Area string, `Bus ID` bigint")

CUSTOM_LOAD_CSV = _schema("""
    timestamp timestamp_ntz, bus_id string, active_power_mw double,
    reactive_power_mvar double
""")

STREAM_MESSAGE = _schema("""
    timestamp timestamp, bus_id string, voltage_magnitude double,
    voltage_angle_rad double, active_power_mw double, frequency_hz double
""")

# --- elements of a system document; a superset of all input formats -------

BUS_ELEMENT = _schema("""
    number bigint, name string, type int, Pd double, Qd double, Gs double,
    Bs double, area string, voltage_magnitude double, angle double,
    base_voltage double, zone string, voltage_max double, voltage_min double
""")

GENERATOR_ELEMENT = _schema("""
    name string, bus_number bigint, bus_name string, type string, Pg double,
    Qg double, qmax double, qmin double, Vg double, mbase double, status int,
    available boolean, pmax double, pmin double, rating double, ramp_up double,
    ramp_down double, min_up_time double, min_down_time double,
    startup_cost double, shutdown_cost double, cost_quadratic double,
    cost_linear double, cost_constant double, cost_fixed double, fuel string,
    unit_group string
""")

BRANCH_ELEMENT = _schema("""
    name string, from_bus bigint, to_bus bigint, from_bus_name string,
    to_bus_name string, resistance double, reactance double,
    shunt_susceptance double, rating double, rating_a double, rating_b double,
    rating_c double, rating_emergency double, ratio double, angle double,
    status int, available boolean, angle_min double, angle_max double,
    type string
""")

LOAD_ELEMENT = _schema("""
    name string, bus_number bigint, bus_name string, area string,
    buses array<bigint>, active_power double, reactive_power double,
    available boolean
""")

SYSTEM_DOCUMENT = T.StructType(
    [
        T.StructField("base_mva", T.DoubleType()),
        T.StructField("buses", T.ArrayType(BUS_ELEMENT)),
        T.StructField("generators", T.ArrayType(GENERATOR_ELEMENT)),
        T.StructField("branches", T.ArrayType(BRANCH_ELEMENT)),
        T.StructField("loads", T.ArrayType(LOAD_ELEMENT)),
    ]
)
