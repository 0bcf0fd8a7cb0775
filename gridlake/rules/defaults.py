"""Rule values that ship with the package.

These are fixed values: names, units, formula keys, level prefixes and group definitions that have to be the
same for the results to be the same. They are data, not logic; every table keeps its natural order because the
order of a field table is also its matching priority.
"""

# ---- fixed values: FA field codes ----------------------------------------------------------------------

FA_SKIP = [
    "INTSURFGEOPOTENT", "SOMMFLU.RAY.SOLA", "SOMMFLU.RAY.THER", "SURFRAYT.SOLA.DE", "SURFRAYT.THER.DE",
    "SURFRAYT.SOL.CL", "SURFRAYT.THER.CL", "SURFRAYT.DIR.SUR", "SURFTEMPERATURE", "SURFRESERV.NEIGE",
    "SURFTENS.TURB.ZO", "SURFTENS.TURB.ME", "SURFFLU.RAY.SOLA", "SURFFLU.RAY.THER", "SURFFLU.LAT.MEVA",
    "SURFFLU.LAT.MSUB", "SURFFLU.MEVAP.EA", "SURFFLU.MSUBL.NE", "SURFFLU.CHA.SENS", "CLPMHAUT.MOD.XFU",
    "CLOUD_WATE", "CLOUD_FRAC", "ICE_CRYSTA", "SIM_REFLEC", "SIM_REFLECTI", "POT_VORTIC", "THETA_VIRT",
    "ABS_VORTIC", "SURFIND.TERREMER", "SURFEVAPOTRANSPI",
]

# prefix, level type, factor applied to the digits that follow it
FA_LEVELS = [
    ("P", "isobaric", 0.01),
    ("S", "model_level", 1),
    ("H", "height", 1),
    ("V", "pv", 0.01),
    ("CLS", "surface", 1),
    ("SURF", "surface", 1),
]

# field code, short name, unit, formula, description
FA_FIELDS = [
    ("TEMPERATURE", "t", "Celsius", "k2c", "Temperature"),
    ("TEMPERATUR", "t", "Celsius", "k2c", "Temperature"),
    ("TEMPE_POTE", "theta", "K", "None", "Potential Temperature"),
    ("THETA_PRIM", "theta_p", "K", "None", "Pseudo-adiabatic potential temperature"),
    ("CLSMAXI.TEMPERAT", "tmax", "Celsius", "k2c", "Temperature"),
    ("CLSMINI.TEMPERAT", "tmin", "Celsius", "k2c", "Temperature"),
    ("HUMI.SPECIFI", "q", "kg kg-1", "None", "Specific Humidity"),
    ("HUMI.SPECIFIQ", "q", "kg kg-1", "None", "Specific Humidity"),
    ("HUMI_RELAT", "r", "%", "percent", "Relative Humidity"),
    ("HUMI_RELATIV", "r", "%", "percent", "Relative Humidity"),
    ("GEOPOTENTI", "gh", "m", "div98", "Geopotential Height"),
    ("GEOPOTENTIEL", "gh", "m", "div98", "Geopotential Height"),
    ("VENT_ZONAL", "u", "m s-1", "None", "U-component of wind"),
    ("VENT_MERID", "v", "m s-1", "None", "V-component of wind"),
    ("VENT_MERIDIE", "v", "m s-1", "None", "V-component of wind"),
    ("CLSVENT.ZONAL", "u10", "m s-1", "None", "10m U-component of wind"),
    ("CLSVENT.MERIDIE", "v10", "m s-1", "None", "10m V-component of wind"),
    ("CLSVENT.MERIDIEN", "v10", "m s-1", "None", "10m V-component of wind"),
    ("CLSU.RAF.MOD.XFU", "gust_u", "m s-1", "None", "U-component of wind gust"),
    ("CLSV.RAF.MOD.XFU", "gust_v", "m s-1", "None", "V-component of wind gust"),
    ("WIND.U.PHYS", "u", "m s-1", "None", "U-component of wind (Physical)"),
    ("WIND.V.PHYS", "v", "m s-1", "None", "V-component of wind (Physical)"),
    ("CLOUD_WATER", "clw", "kg kg-1", "None", "Cloud water content"),
    ("ICE_CRYSTAL", "cli", "kg kg-1", "None", "Cloud ice content"),
    ("SNOW", "asnow", "kg kg-1", "None", "Snow water equivalent content"),
    ("RAIN", "arain", "kg kg-1", "None", "Rain water content"),
    ("GRAUPEL", "agrau", "kg kg-1", "None", "Graupel content"),
    ("TKE", "tke", "m2 s-2", "None", "Turbulent Kinetic Energy"),
    ("TEMPE_POTENT", "theta", "K", "None", "Potential Temperature"),
    ("THETA_VIRTUA", "theta_v", "K", "None", "Virtual Potential Temperature"),
    ("VERT.VELOC", "w", "m s-1", "None", "Vertical Velocity"),
    ("VERT.VELOCIT", "w", "m s-1", "None", "Vertical Velocity"),
    ("VITESSE_VERT", "w", "m s-1", "None", "Vertical Velocity"),
    ("VITESSE_VE", "w", "m s-1", "None", "Vertical Velocity"),
    ("ABS_VORTICIT", "vo", "s-1", "None", "Absolute Vorticity"),
    ("DIVERGENCE", "d", "s-1", "None", "Divergence"),
    ("SIM_REFLECTI", "dbz", "dBZ", "None", "Simulated Reflectivity"),
    ("PRESSURE", "p", "Pa", "None", "Pressure"),
    ("SURFTEMPERATURE", "ts", "Celsius", "k2c", "Surface Temperature (Skin)"),
    ("CLSTEMPERATURE", "t2", "Celsius", "k2c", "2m Temperature"),
    ("CLSHUMI.RELATIVE", "r2", "%", "percent", "2m Relative Humidity"),
    ("CLSHUMI.SPECIFIQ", "q2", "kg kg-1", "None", "2m Specific Humidity"),
    ("SURFCAPE.POS.F00", "cape", "J kg-1", "None", "Convective Available Potential Energy"),
    ("MSLPRESSURE", "prmsl", "Pa", "None", "Mean Sea Level Pressure"),
    ("SURFPRESSION", "ps", "Pa", "None", "Surface pressure"),
    ("SURFNEBUL.HAUTE", "hcc", "0-1", "None", "High Cloud Cover"),
    ("SURFNEBUL.MOYENN", "mcc", "0-1", "None", "Medium Cloud Cover"),
    ("SURFNEBUL.BASSE", "lcc", "0-1", "None", "Low Cloud Cover"),
    ("SURFNEBUL.TOTALE", "totcc", "0-1", "None", "Total Cloud Cover"),
    ("SURFISOTPW0.MALT", "iso_zero", "m", "div98", "0C Isotherm Height"),
    ("SURFDIAGHAIL", "hail", "kg m-2", "acc", "Hail Accumulation"),
    ("SURFACCPLUIE", "tp", "kg m-2", "acc", "Total Precipitation Accumulation"),
    ("SURFACCNEIGE", "tsnowp", "kg m-2", "acc", "Total Snowfall Accumulation"),
    ("SURFPREC.EAU.CON", "twatp_con", "kg m-2", "acc", "Convective Precip"),
    ("SURFPREC.EAU.GEC", "twatp_gec", "kg m-2", "acc", "Large Scale Precip"),
    ("SURFPREC.NEI.CON", "tsnowp_con", "kg m-2", "acc", "Convective Precip"),
    ("SURFPREC.NEI.GEC", "tsnowp_gec", "kg m-2", "acc", "Large Scale Precip"),
    ("AOD_DST", "aod_dst", "", "None", "Aerosol Optical Depth (Dust)"),
    ("ZN_DST", "zn_dst", "", "None", "Aerosol Optical Depth (Dust)"),
    ("FLX_DST", "flx_dst", "", "None", "Aerosol Optical Depth (Dust)"),
    ("ZM_DST", "zm_dst", "", "None", "Aerosol Optical Depth (Dust)"),
]

# output name, short name, unit, description, recipe, sources
DERIVED_FIELDS = [
    ("ws", "ws", "m s-1", "Wind Speed", "vector_magnitude", ["u", "v"]),
    ("wdir", "wdir", "degrees", "Wind Direction", "vector_direction", ["u", "v"]),
    ("ws10", "ws10", "m s-1", "10m Wind Speed", "vector_magnitude", ["u10", "v10"]),
    ("wdir10", "wdir10", "degrees", "10m Wind Direction", "vector_direction", ["u10", "v10"]),
    ("gust_spd", "gust", "m s-1", "Wind Gust Speed", "vector_magnitude", ["gust_u", "gust_v"]),
    ("gust_dir", "gust_dir", "degrees", "Wind Gust Direction", "vector_direction", ["gust_u", "gust_v"]),
    ("rain_aladin", "tp_aladin", "kg m-2", "Rain Accumulation", "accumulation", ["twatp_con", "twatp_gec"]),
    ("tsnowp_aladin", "tsnowp_aladin", "kg m-2", "Snow Accumulation", "accumulation",
     ["tsnowp_con", "tsnowp_gec"]),
]

# source short name, labels of the amounts to build
ACCUMULATIONS = [
    ("twatp_con", ["RR3h", "RR6h", "RR12h", "RR24h"]),
    ("twatp_gec", ["RR3h", "RR6h", "RR12h", "RR24h"]),
    ("tp", ["RR3h", "RR6h", "RR12h", "RR24h"]),
    ("tp_aladin", ["RR3h", "RR6h", "RR12h", "RR24h"]),
    ("tsnowp", ["RR3h", "RR6h", "RR12h", "RR24h"]),
    ("tsnowp_con", ["RR3h", "RR6h", "RR12h", "RR24h"]),
    ("tsnowp_gec", ["RR3h", "RR6h", "RR12h", "RR24h"]),
    ("tsnowp_aladin", ["RR3h", "RR6h", "RR12h", "RR24h"]),
]

# ---- fixed values: GRIB short names --------------------------------------------------------------------

GRIB_SKIP = ["absv", "pv", "papt"]

# message short name, short name, unit, formula, description
GRIB_FIELDS = [
    ("t", "t", "Celsius", "k2c", "Temperature"),
    ("q", "q", "kg kg-1", "None", "Specific Humidity"),
    ("r", "r", "%", "None", "Relative Humidity"),
    ("gh", "gh", "m", "div98", "Geopotential Height"),
    ("z", "gh", "m", "div98", "Geopotential Height"),
    ("u", "u", "m s-1", "None", "U-wind component"),
    ("v", "v", "m s-1", "None", "V-wind component"),
    ("w", "w", "Pa s-1", "None", "Vertical Velocity (pressure)"),
    ("10u", "10u", "m s-1", "None", "10m U-wind component"),
    ("10v", "10v", "m s-1", "None", "10m V-wind component"),
    ("2t", "2t", "Celsius", "k2c", "2m Temperature"),
    ("2r", "2r", "%", "None", "2m Relative Humidity"),
    ("2q", "2q", "kg kg-1", "None", "2m Specific Humidity"),
    ("msl", "prmsl", "Pa", "None", "MSL Pressure"),
    ("sp", "ps", "Pa", "None", "Surface Pressure"),
    ("lnsp", "lnsp", "ln(Pa)", "None", "Log of Surface Pressure"),
    ("tcc", "totcc", "%", "None", "Total Cloud Cover"),
    ("hcc", "hcc", "%", "None", "High Cloud Cover"),
    ("mcc", "mcc", "%", "None", "Medium Cloud Cover"),
    ("lcc", "lcc", "%", "None", "Low Cloud Cover"),
    ("tp", "tp", "kg m-2", "acc", "Total Precipitation"),
    ("twatp", "tp", "kg m-2", "acc", "Total Precipitation (Water)"),
    ("sf", "tsnowp", "kg m-2", "acc", "Snowfall"),
    ("tsnowp", "tsnowp", "kg m-2", "acc", "Total Snowfall (Water)"),
    ("snol", "tsnowp_gec", "kg m-2", "acc", "Large Scale Snowfall"),
    ("snoc", "tsnowp_con", "kg m-2", "acc", "Convective Snowfall"),
    ("lsp", "twatp_gec", "kg m-2", "acc", "Large Scale Precipitation"),
    ("cp", "twatp_con", "kg m-2", "acc", "Convective Precipitation"),
    ("lswp", "twatp_gec", "kg m-2", "acc", "Large Scale Water Precipitation"),
    ("cwp", "twatp_con", "kg m-2", "acc", "Convective Water Precipitation"),
    ("cape", "cape", "J kg-1", "None", "Convective Available Potential Energy"),
    ("CAPE_INS", "cape", "J kg-1", "None", "Instantaneous CAPE"),
    ("h", "orog", "m", "None", "Model Surface Height / Orography"),
    ("lsm", "lsm", "0-1", "None", "Land-Sea Mask"),
    ("snom", "tsnowp", "m", "acc", "Snow Depth"),
    ("vis", "vis", "m", "None", "Visibility"),
    ("ptype", "ptype", "", "None", "Precipitation type"),
    ("gust", "gust", "m s-1", "None", "Wind Gust"),
    ("wg", "gust", "m s-1", "None", "Wind Gust"),
]

# level type of the message, level type of the field
GRIB_LEVEL_TYPES = [
    ("isobaricInhPa", "isobaric"),
    ("heightAboveGround", "height"),
    ("surface", "surface"),
    ("meanSea", "meanSea"),
    ("potentialVorticity", "pv"),
    ("entireAtmosphere", "atmosphere"),
    ("theta", "theta"),
]

# ---- fixed values: groups ------------------------------------------------------------------------------

# group, level types, parameters, exclude
GROUPS = [
    ("surface", ["surface", "height"], [], ["RR3h", "RR6h", "RR12h", "RR24h"]),
    ("alt_pressure", ["isobaric"], [], []),
    ("alt_pv", ["pv"], [], []),
    ("surface_3h", [], ["RR3h"], []),
    ("surface_6h", [], ["RR6h"], []),
    ("surface_12h", [], ["RR12h"], []),
    ("surface_24h", [], ["RR24h"], []),
]
