"""ecoflux.sources"""
